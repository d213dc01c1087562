import pytest

from txguard.sources import kafka
from txguard.sources.kafka import KafkaSettings

PLAIN = KafkaSettings("a:1, b:2 ,,", "in", "out")
SECURE = KafkaSettings("a:1", "in", "out", "SASL_SSL", 'us"er', "pa\\ss")


def test_server_list_is_trimmed():
    assert kafka.connection_options(PLAIN) == {
        "kafka.bootstrap.servers": "a:1,b:2",
        "kafka.security.protocol": "PLAINTEXT",
    }


def test_login_only_where_the_protocol_asks():
    options = kafka.connection_options(SECURE)
    assert options["kafka.sasl.mechanism"] == "PLAIN"
    assert options["kafka.sasl.jaas.config"] == (
        'org.apache.kafka.common.security.plain.PlainLoginModule required username="us\\"er" password="pa\\\\ss";'
    )
    with pytest.raises(ValueError):
        kafka.connection_options(KafkaSettings(security_protocol="SASL_SSL"))


def test_stream_reads_new_messages_and_tolerates_loss():
    options = kafka.stream_options(PLAIN, max_offsets_per_trigger=500)
    assert options["subscribe"] == "in"
    assert options["startingOffsets"] == "latest"
    assert options["failOnDataLoss"] == "false"
    assert options["maxOffsetsPerTrigger"] == "500"
    assert "endingOffsets" not in options


def test_bounded_read_covers_everything_stored():
    options = kafka.batch_options(PLAIN, min_partitions=64)
    assert (options["startingOffsets"], options["endingOffsets"]) == ("earliest", "latest")
    assert options["minPartitions"] == "64"
    assert not any("commit" in key or "group" in key for key in options)


def test_sink_shares_the_connection():
    options = kafka.sink_options(SECURE)
    assert options["topic"] == "out"
    assert options["kafka.compression.type"] == "gzip"
    assert options["kafka.sasl.mechanism"] == "PLAIN"
    assert kafka.sink_options(SECURE, "raw")["topic"] == "raw"


def test_defaults():
    settings = KafkaSettings()
    assert (settings.topic, settings.output_topic) == ("transactions", "fraud_predictions")


class Recorder:
    """Takes the calls of a reader or writer and remembers the options."""

    def __init__(self):
        self.seen = {}

    def format(self, name):
        self.seen["format"] = name
        return self

    def options(self, **options):
        self.seen.update(options)
        return self

    def option(self, key, value):
        self.seen[key] = value
        return self

    def outputMode(self, mode):
        self.seen["mode"] = mode
        return self

    def load(self):
        return self

    def save(self):
        self.seen["saved"] = True


def test_alert_writer_appends_with_a_checkpoint():
    class Messages:
        writeStream = Recorder()

    seen = kafka.alert_writer(Messages(), PLAIN, "/state").seen
    assert (seen["format"], seen["mode"], seen["checkpointLocation"], seen["topic"]) == ("kafka", "append", "/state", "out")


def test_publish_goes_to_the_input_topic_unless_told():
    class Messages:
        write = Recorder()

    kafka.publish(Messages(), PLAIN)
    assert Messages.write.seen["topic"] == "in" and Messages.write.seen["saved"]


def test_read_stream_uses_the_kafka_source():
    class Session:
        readStream = Recorder()

    assert kafka.read_stream(Session(), PLAIN).seen["format"] == "kafka"


def test_bounded_read_caps_the_oldest(spark):
    rows = spark.range(50).selectExpr("timestamp_seconds(id % 10) timestamp", "0 partition", "id offset")

    class Source(Recorder):
        def load(self):
            return rows

    class Session:
        read = Source()
        sparkContext = spark.sparkContext

    kept = kafka.read_bounded(Session(), PLAIN, max_messages=7)
    assert sorted(row.offset for row in kept.collect()) == [0, 1, 10, 11, 20, 30, 40]
    assert kafka.read_bounded(Session(), PLAIN, max_messages=None).count() == 50
