"""Near duplicates by a join of MinHash signatures over an inverted index of their coordinates.

Texts are posted under each pair of coordinate and value. Two texts above the match threshold agree
in at least ``MATCHES`` of ``COORDINATES`` values, so they meet in a posting list that is among the
rarest ``COORDINATES - MATCHES + 1`` of both: this prefix is merged, the frequent lists are skipped.

A list is not turned into all its pairs. Its most connected text leads it, and every other text is
compared with the leader on full sets. What two texts of a list have in common beyond the leader
shows in their differences from it: a pair that is linked although one of the two is not linked to
the leader must share many differences (the bound is in :func:`compare`). So the texts are posted
once more, under leader and difference, again only under the rarest of their differences: what a text
has to itself comes first and what a whole family shares comes last, so that texts meet where enough
is left to link them. These lists, if they hold a text not linked to the leader, get a leader of their
own. That connects groups of near copies. What is then still apart, and not ruled out by the bound, is
compared each with each in lists of up to ``FEW`` texts; larger ones go on
with further leaders. Leaders of such lists are the strongest of their texts
in one order of all texts, so they become weaker step by step and every pair ends with a leader that
both are linked to, or with a comparison of the two. Lists whose texts are connected already are
done. A step costs rows, not pairs of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txguard.llm.components import connected
from txguard.llm.documents import give_back, per_value, utf8
from txguard.llm.shingles import Signer, digest, shingle_set
from txguard.session import cut_lineage, materialise

SHINGLE_WORDS = 5
THRESHOLD = (3, 4)  # intersection to union, as whole numbers
# A pair at the threshold agrees in 48 of 64 coordinates on average; fewer than 32 happen about three
# times in a million, and less often above the threshold.
COORDINATES = 64
MATCHES = 32
# Texts of a list of differences that are compared each with each, instead of with a leader, where a first round
# with leaders has left the list open.
FEW = 1000

_MARKS = "n int, digest binary, signature array<long>"
_MARKS_ARROW = pa.struct([("n", pa.int32()), ("digest", pa.binary()), ("signature", pa.list_(pa.int64()))])
_SET = pa.struct([("digest", pa.binary()), ("shingles", pa.list_(pa.int64()))])
_FORM = "linked boolean, extra int, cost int, size int, prefix array<long>, rest array<long>"
_FORM_ARROW = pa.struct(
    [
        ("linked", pa.bool_()),
        ("extra", pa.int32()),
        ("cost", pa.int32()),
        ("size", pa.int32()),
        ("prefix", pa.list_(pa.int64())),
        ("rest", pa.list_(pa.int64())),
    ]
)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``id_col``, ``n_shingles``, ``component_id`` (smallest id reachable over links) and ``kept``.

    Two texts are linked when their sets of five-word shingles have a similarity of 0.75 or more. A
    text of fewer words is one shingle; null and empty texts and texts of white space have none, are
    linked with nothing and keep their own id. Copies of a set are linked, whatever their number.
    Repeated rows each get their row, and rows that share an id but not their text each go by their
    own text. Rows without an id take the component of an equal set with an id, else null; ``kept``
    is then true. Ids may be of any type that has an order. An empty table gives no rows; other
    columns are ignored.
    """
    marks = cut_lineage(signed(docs, id_col, text_col))
    heads = marks.filter("_n > 0 AND _id IS NOT NULL").groupBy("_digest")
    nodes = cut_lineage(heads.agg(F.min("_id").alias("_first"), F.first("_signature").alias("signature")))
    # sets are numbered; the numbers stay, as they go by the place in the written table
    nodes = nodes.withColumn("node", F.monotonically_increasing_id())
    labels = linked_nodes(nodes, docs, id_col, text_col)
    linked = cut_lineage(nodes.select("node", "_first", F.col("_digest").alias("_of")).join(labels, "node", "left"))
    least = linked.filter("component IS NOT NULL").groupBy("component").agg(F.min("_first").alias("_least"))
    # written on its own, so that the join below reads two plain shuffles and can split a frequent set
    found = cut_lineage(linked.join(least, "component", "left").select("_of", F.coalesce("_least", "_first").alias("_component")))
    rows = marks.select("_id", "_n", "_digest").join(found, F.col("_digest") == F.col("_of"), "left")
    component = F.coalesce("_component", "_id")
    return rows.select(
        F.col("_id").alias(id_col),
        F.col("_n").cast("long").alias("n_shingles"),
        component.alias("component_id"),
        F.col("_id").eqNullSafe(component).alias("kept"),
    )


def signed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Id, size of the shingle set, its digest and its signature. Empty sets have no signature."""

    def make():
        signer = Signer(COORDINATES)

        def mark(text: bytes) -> dict:
            shingles = shingle_set(text, SHINGLE_WORDS)
            n = len(shingles)
            return {
                "n": n,
                "digest": digest(shingles) if n else None,
                "signature": signer.sign(shingles).view(np.int64) if n else None,
            }

        return mark

    marked = docs.select(F.col(id_col).alias("_id"), per_value(make, f"struct<{_fields(_MARKS)}>", _MARKS_ARROW)(utf8(text_col)).alias("_m"))
    return marked.select("_id", F.col("_m.n").alias("_n"), F.col("_m.digest").alias("_digest"), F.col("_m.signature").alias("_signature"))


def linked_nodes(nodes: DataFrame, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``node`` and ``component`` of all nodes that have a link at the threshold, confirmed on full sets."""
    members = cut_lineage(led(nodes.select("node", "signature")))
    sets = materialise(sets_of(members, nodes, docs, id_col, text_col), "shingle-sets")
    # lists of signature coordinates first; the lists of differences from their leaders are a round of their own,
    # because those leaders stand in for others and need not be stronger than their texts
    forms = materialise(compared(members, sets), "forms")
    labels = materialise(connected(_links(forms), "a", "b"), "labels")
    met = None
    while True:
        touched = forms if met is None else met.join(forms.select("leader").distinct(), "leader", "left_semi")
        few, many = _meeting(touched, labels, met, 0 if met is None else FEW)
        if few is None and many is None:
            return labels
        # tables, not checkpoints: a plan's size estimate would grow with every round
        links = materialise(confirmed(few, sets), "links") if few is not None else None
        if many is not None:
            forms = materialise(compared(many, sets), "forms")
            links = _links(forms) if links is None else links.union(_links(forms))
            # a list grows when texts come to its leader later on, so all texts of a leader with new ones are looked at
            met = forms if met is None else met.unionByName(forms)
        stars = labels.select(F.col("node").alias("a"), F.col("component").alias("b"))
        labels = materialise(connected(stars.union(links), "a", "b"), "labels")
        if many is None:
            return labels


def _links(forms: DataFrame) -> DataFrame:
    return forms.filter("linked").select(F.col("node").alias("a"), F.col("leader").alias("b"))


def led(nodes: DataFrame) -> DataFrame:
    """Distinct pairs of a node, with its ``weight``, and a leader of one of its prefix lists."""
    # the key needs no coordinate number: permutations differ, and a chance agreement only adds a pair
    postings = nodes.select("node", F.explode("signature").alias("key"))
    lists = postings.groupBy("key").agg(F.count(F.lit(1)).alias("length")).filter("length > 1")
    shared = postings.join(lists, "key")
    # coordinates held by one node are the rarest; the others of its prefix are the first of the sorted rest
    rest = F.array_sort(F.collect_list(F.struct("length", "key")))
    prefix = F.size("rest") - (MATCHES - 1)
    by_node = (
        shared.groupBy("node")
        .agg(rest.alias("rest"), F.sum("length").alias("weight"))
        .filter(prefix > 0)
        .select("node", "weight", F.explode(F.slice("rest", F.lit(1), prefix)).alias("at"))
        .select("node", "weight", F.col("at.key").alias("key"))
    )
    by_node = cut_lineage(by_node)
    strongest = F.max(F.struct("weight", "node"))
    leaders = by_node.groupBy("key").agg(strongest.alias("top"), F.count(F.lit(1)).alias("length"))
    leaders = cut_lineage(leaders.filter("length > 1").select("key", "top"))
    votes = cut_lineage(
        by_node.join(leaders, "key")
        .filter("node <> top.node")
        .groupBy("node", "weight", F.col("top.node").alias("leader"), F.col("top.weight").alias("strength"))
        .agg(F.count(F.lit(1)).alias("lists"))
    )
    return _gathered(votes)


def _gathered(votes: DataFrame) -> DataFrame:
    """Node, weight and leader, where a leader that has a stronger one itself gives way to it, twice.

    Any text can stand in for the leader of a list, whether it is in the list or not: the comparison
    of :func:`compare` holds for every set. Few leaders in the middle of their groups make it cheap.
    A leader is moved as a member of its own list too, so that it keeps a stand-in in common with it.
    """
    choice = F.max_by("leader", F.struct("lists", "strength", "leader"))
    stronger = votes.filter("struct(strength, leader) > struct(weight, node)")
    # written on its own, so that the joins read plain shuffles and a leader of many nodes can be split
    upward = cut_lineage(stronger.groupBy(F.col("node").alias("_from")).agg(choice.alias("_to")))
    leaders = votes.select(F.col("leader").alias("node"), F.col("strength").alias("weight"), "leader").distinct()
    members = cut_lineage(votes.select("node", "weight", "leader").union(leaders))
    for _ in range(2):
        moved = members.join(upward, F.col("leader") == F.col("_from"), "left")
        members = cut_lineage(moved.select("node", "weight", F.coalesce("_to", "leader").alias("leader")).distinct())
    return members.filter("node <> leader")


def sets_of(members: DataFrame, nodes: DataFrame, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Shingle sets of the nodes in ``members``, shingled again from the texts with their ids."""
    wanted = members.select("node").union(members.select("leader")).distinct()
    wanted = cut_lineage(nodes.select("node", "_first", "_digest").join(wanted, "node", "left_semi"))

    def make():
        def read(text: bytes) -> dict:
            shingles = shingle_set(text, SHINGLE_WORDS)
            return {"digest": digest(shingles), "shingles": shingles.view(np.int64)}

        return read

    ids = wanted.select(F.col("_first").alias("_id")).distinct()
    texts = docs.select(F.col(id_col).alias("_id"), utf8(text_col).alias("_text")).join(ids, "_id", "left_semi")
    read = texts.select(per_value(make, "struct<digest: binary, shingles: array<long>>", _SET)("_text").alias("s"))
    # an id can have several texts; the digest tells which is meant
    found = read.select("s.*").join(wanted.select("node", F.col("_digest").alias("digest")), "digest")
    return found.select("node", "shingles").dropDuplicates(["node"])


def _meeting(forms: DataFrame, labels: DataFrame, met: DataFrame | None, limit: int) -> tuple[DataFrame | None, DataFrame | None]:
    """What is left to compare in the lists of differences that may hold a link between components.

    A link that is looked for has a node that is not linked to the leader the differences are from;
    the bounds of :func:`compare` rule nodes out that can have none in a list. Pairs ``a``, ``b`` of
    the lists with at most ``limit`` nodes come first. Of the others, node, weight and leader come
    second: the leader is the strongest node of its list; pairs in ``met`` have been compared already.
    None where there is nothing of the kind.
    """
    p, q = THRESHOLD
    of = labels.select("node", F.col("component").alias("_component"))
    rows = forms.join(of, "node", "left").withColumn("component", F.coalesce("_component", "node")).drop("_component")
    least_extra = F.min(F.when(~F.col("linked"), F.col("extra"))).alias("least_extra")
    apart = F.min("component") < F.max("component")
    groups = rows.groupBy("leader").agg(least_extra, F.min("cost").alias("least_cost"), apart.alias("apart"))
    groups = cut_lineage(groups.filter("apart AND least_extra IS NOT NULL").drop("apart"))
    linked = F.col("linked")

    def enough(left: Column, cost: Column) -> Column:
        """Whether so many common differences can be left that two nodes are linked."""
        return F.coalesce(left * (p + q) >= cost, F.lit(False))

    # what a node and the cheapest partner that its leader's list can have for it come to
    cheapest = F.when(linked, F.col("least_extra") + F.col("cost")).otherwise(F.col("extra") + F.col("least_cost"))
    near = rows.join(groups, "leader").withColumn("cheapest", cheapest).withColumn("needed", F.col("size") - F.size("prefix") + 1)
    near = near.filter((F.size("prefix") > 0) & enough(F.col("size"), F.col("cheapest"))).withColumnRenamed("leader", "under")
    near = materialise(near.drop("least_extra", "least_cost"), "near")
    spread = _rarest(near).filter((F.col("left") >= F.col("needed")) & enough(F.col("left"), F.col("cheapest")))
    spread = materialise(spread.drop("needed", "cheapest"), "spread")
    key = ["under", "difference"]
    facts = spread.groupBy(*key).agg(
        least_extra,
        apart.alias("apart"),
        F.min(F.when(linked, F.col("cost"))).alias("least_linked"),
        F.max(F.when(linked, F.col("left"))).alias("most_linked"),
        F.min(F.when(~linked, F.col("cost"))).alias("least_other"),
        F.max(F.when(~linked, F.col("left"))).alias("most_other"),
        F.count_if(~linked).alias("others"),
    )
    facts = materialise(facts.filter("apart AND others > 0").drop("apart"), "facts")

    # common differences are at most those left in the lists of both; a partner is linked to the leader or is not
    as_one = enough(F.least("left", "most_linked"), F.col("extra") + F.col("least_linked")) | (
        (F.col("others") > 1) & enough(F.least("left", "most_other"), F.col("extra") + F.col("least_other"))
    )
    as_other = enough(F.least("left", "most_other"), F.col("least_extra") + F.col("cost"))
    as_one, as_other = ~linked & as_one, linked & as_other
    kept = spread.join(facts, key).filter(as_one | as_other)
    kept = materialise(kept.select(*key, "node", "weight", "component", "linked", "extra", "cost", "left"), "kept")
    lists = kept.groupBy(*key).agg(
        F.max(F.struct("weight", "node")).alias("top"), F.min("linked").alias("all_linked"), apart.alias("apart"), F.count(F.lit(1)).alias("n")
    )
    lists = materialise(lists.filter("apart AND NOT all_linked").select(*key, F.col("top.node").alias("leader"), "n"), "lists")
    sizes = lists.agg(F.count_if(F.col("n") <= limit).alias("few"), F.count_if(F.col("n") > limit).alias("many")).first()
    few = many = None
    if sizes.few:
        short = kept.join(lists.filter(F.col("n") <= limit).select(*key), key)
        one = short.filter("NOT linked").select(
            *key, F.col("node").alias("a"), F.col("component").alias("a_component"), "extra", F.col("left").alias("a_left")
        )
        other = short.select(*key, F.col("node").alias("b"), F.col("component").alias("b_component"), "cost", F.col("left").alias("b_left"))
        close = enough(F.least("a_left", "b_left"), F.col("extra") + F.col("cost"))
        pairs = one.join(other, key).filter(close & (F.col("a_component") != F.col("b_component")))
        few = materialise(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "few")
    if sizes.many:
        long = kept.join(lists.filter(F.col("n") > limit).select(*key, "leader"), key).filter("node <> leader")
        many = long.select("node", "weight", "leader").distinct()
        if met is not None:
            many = many.join(met.select("node", "leader"), ["node", "leader"], "left_anti")
        many = materialise(many, "many")
        many = None if many.isEmpty() else many
    return few, many


def _rarest(near: DataFrame) -> DataFrame:
    """Each node of ``near`` with its differences that can be shared in a link looked for, the rarest first.

    Those are the ones held under the same leader by nodes of two components, one of them not linked
    to the leader. ``left`` counts a difference and those after it; ties go by the difference, so that
    nodes under one leader have one order. What a node has to itself is left out, and
    what a whole family has comes last, where few nodes still have enough left.
    """
    key = ["under", "difference"]
    each = near.select("under", "node", "component", "linked", F.explode(F.concat("prefix", "rest")).alias("difference"))
    lengths = each.groupBy(*key).agg(
        F.count(F.lit(1)).alias("length"), (F.min("component") < F.max("component")).alias("apart"), F.min("linked").alias("all_linked")
    )
    lengths = materialise(lengths.filter("apart AND NOT all_linked").select(*key, "length"), "lengths")
    rest = F.array_sort(F.collect_list(F.struct("length", "difference")))
    ranked = each.select("under", "node", "difference").join(lengths, key).groupBy("under", "node").agg(rest.alias("ranked"))
    rows = near.drop("prefix", "rest").join(ranked, ["under", "node"])
    placed = rows.select(*rows.columns, F.posexplode("ranked.difference").alias("place", "difference"))
    return placed.withColumn("left", F.size("ranked") - F.col("place")).drop("ranked", "place")


def compare(node: np.ndarray, leader: np.ndarray) -> dict:
    """Whether a set is linked to its leader's, and which differences from it it has to share with a partner.

    With p to q the threshold, r shingles of the leader missing and a added, the weight is q*r + p*a.
    For two sets with weights w and v and s common differences, intersection and union are linear in
    these numbers, and the pair is linked exactly if (p+q)*s >= w + v - (q-p)*size, where size is
    that of the leader's set; with the leader itself if w <= (q-p)*size. Only pairs in which one is
    not linked to the leader have to be found. A set that is linked therefore needs a partner that is
    not, so s >= (w+1)/(p+q). One that is not needs s >= (w - (q-p)*size)/q, as v >= p*s. Sorted in
    one order, two sets with s common differences share one among the first ``number - s + 1`` of both;
    ``prefix`` are these additions first, ``rest`` the others.
    """
    p, q = THRESHOLD
    added = np.setdiff1d(node, leader, assume_unique=True)
    missing = np.setdiff1d(leader, node, assume_unique=True)
    number = len(added) + len(missing)
    weight = q * len(missing) + p * len(added)
    excess = weight - (q - p) * len(leader)
    needed = -(-(weight + 1) // (p + q)) if excess <= 0 else max(1, -(-excess // q))
    differences = np.concatenate([added, ~missing])
    first = max(0, number - needed + 1)
    return {
        "linked": excess <= 0,
        "extra": excess,
        "cost": weight,
        "size": number,
        "prefix": differences[:first],
        "rest": differences[first:],
    }


def compared(members: DataFrame, sets: DataFrame) -> DataFrame:
    """Each pair of node and leader with the numbers of :func:`compare`."""

    @F.arrow_udf(f"struct<{_fields(_FORM)}>")
    def form(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for nodes, leaders in batches:
            yield pa.array((compare(a.values.to_numpy(), b.values.to_numpy()) for a, b in zip(nodes, leaders, strict=True)), _FORM_ARROW)
        give_back()

    own = sets.withColumnRenamed("shingles", "own")
    others = sets.select(F.col("node").alias("leader"), F.col("shingles").alias("others"))
    joined = members.join(own, "node").join(others, "leader")
    return joined.select("node", "weight", "leader", form("own", "others").alias("form")).select("node", "weight", "leader", "form.*")


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs whose full sets reach the threshold."""
    p, q = THRESHOLD

    @F.arrow_udf("boolean")
    def similar(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for first, second in batches:
            yield pa.array(
                (_similar(a.values.to_numpy(), b.values.to_numpy(), p, q) for a, b in zip(first, second, strict=True)), pa.bool_()
            )
        give_back()

    def named(name: str) -> DataFrame:
        return sets.select(F.col("node").alias(name), F.col("shingles").alias(f"{name}_set"))

    joined = pairs.join(named("a"), "a").join(named("b"), "b")
    return joined.select("a", "b", similar("a_set", "b_set").alias("linked")).filter("linked").select("a", "b")


def _similar(a: np.ndarray, b: np.ndarray, p: int, q: int) -> bool:
    common = len(np.intersect1d(a, b, assume_unique=True))
    return q * common >= p * (len(a) + len(b) - common)


def _fields(columns: str) -> str:
    return ", ".join(f"{name}: {kind}" for name, kind in (column.split(" ") for column in columns.split(", ")))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each group, with all columns: the one with the smallest id."""
    found = near_duplicates(docs.select(id_col, text_col), id_col, text_col)
    # an id that also stays, with another text, stays whole
    told = found.groupBy(F.col(id_col).alias("_gone")).agg(F.max("kept").alias("_kept")).filter("NOT _kept").select("_gone")
    return docs.join(told, F.col(id_col) == F.col("_gone"), "left_anti")
