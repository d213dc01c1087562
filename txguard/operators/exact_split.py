"""Stratified split and folds with exact class counts, without ranking whole classes.

Rows are ordered inside their class by the digest of their id, and the first share goes to each
part. Only the digests at which the parts end have to be known: four constants for two classes and
three parts. They are found from counts per digest prefix, then from the few rows that share the
prefix in which a part ends. Assigning the split is then a plain projection.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txguard.functions.buckets import SEED, row_key
from txguard.operators.prefix import running_sums
from txguard.schema import LABEL

# Hexadecimal digits counted in the first pass: at most 4,096 counts per class reach the driver.
PREFIX_DIGITS = 3


def part_sizes(counts: dict[int, int], share: float) -> dict[int, int]:
    """Rows per class of a part with ``share`` of all rows, rounded up in total and split in proportion.

    Rows left over by rounding down go to the classes with the largest remainders.
    """
    total = sum(counts.values())
    # the tolerance keeps 0.2 * 15 from becoming 4
    size = ceil(share * total - 1e-9)
    exact = {label: size * n / total if total else 0.0 for label, n in counts.items()}
    sizes = {label: int(value) for label, value in exact.items()}
    by_remainder = sorted(exact, key=lambda label: (sizes[label] - exact[label], label))
    for label in by_remainder[: size - sum(sizes.values())]:
        sizes[label] += 1
    return sizes


def assign_exact_split(
    df: DataFrame,
    seed: int = SEED,
    test_share: float = 0.20,
    validation_share: float = 0.20,
    key: str = "transaction_id",
    label: str = LABEL,
) -> DataFrame:
    """Adds ``split``. Copies of one id stay together, so counts are exact up to the copies of the last id.

    Rows without an id are placed by their content. The label is 0 or 1, else the call is refused.
    """
    digest = F.md5(F.concat(F.lit(f"{seed}:"), row_key(df, key)))
    per_class = _prefix_counts(df, digest, label)
    sizes = {name: sum(prefixes.values()) for name, prefixes in per_class.items()}
    test = part_sizes(sizes, test_share)
    rest = {name: n - test[name] for name, n in sizes.items()}
    remaining_share = validation_share / (1 - test_share) if test_share < 1 else 0.0
    validation = part_sizes(rest, remaining_share)
    ends = {name: (test[name], test[name] + validation[name]) for name in sizes}

    cuts = _cut_digests(df, digest, label, per_class, ends)
    return df.withColumn("split", _part(digest, label, cuts, [F.lit("test"), F.lit("validation"), F.lit("train")]))


def assign_exact_folds(
    df: DataFrame, folds: int = 3, seed: int = SEED, key: str = "transaction_id", label: str = LABEL
) -> DataFrame:
    """Adds ``fold``: equal class counts in every fold, the first ones taking a row more where they do not divide.

    Copies of one id stay together; rows without an id are placed by their content.
    """
    digest = F.md5(F.concat(F.lit(f"fold:{seed}:"), row_key(df, key)))
    per_class = _prefix_counts(df, digest, label)
    ends = {}
    for name, prefixes in per_class.items():
        each, more = divmod(sum(prefixes.values()), folds)
        ends[name] = tuple(each * k + min(k, more) for k in range(1, folds))
    cuts = _cut_digests(df, digest, label, per_class, ends)
    return df.withColumn("fold", _part(digest, label, cuts, [F.lit(k) for k in range(folds)]))


def _prefix_counts(df: DataFrame, digest: Column, label: str) -> dict[int, dict[str, int]]:
    """Rows per class and digest prefix. The label is checked in the same pass, before rows reach the driver."""
    known = F.col(label).isin(0, 1)
    name = F.when(known, F.col(label).cast("int"))
    prefix = F.when(known, F.substring(digest, 1, PREFIX_DIGITS))
    counted = df.groupBy(name.alias("label"), prefix.alias("prefix")).agg(F.count("*").alias("n")).collect()
    per_class: dict[int, dict[str, int]] = {}
    for row in counted:
        if row.label is None:
            raise ValueError(f"{row.n} rows have a label other than 0 and 1")
        per_class.setdefault(row.label, {})[row.prefix] = row.n
    return per_class


def _part(digest: Column, label: str, cuts: dict[int, list[str]], parts: list[Column]) -> Column:
    """The first part whose last digest is not passed; the last part takes the rest."""
    found = parts[-1]
    for name, ends in cuts.items():
        for part, end in reversed(list(zip(parts, ends, strict=False))):
            found = F.when((F.col(label) == name) & (digest <= end), part).otherwise(found)
    return found


def _cut_digests(
    df: DataFrame, digest: Column, label: str, per_class: dict[int, dict[str, int]], ends: dict[int, tuple[int, ...]]
) -> dict[int, list[str]]:
    """Last digest of each part, per class (empty text for an empty part)."""
    wanted = []  # class, which end, prefix it falls in, rows to take inside the prefix
    for name, prefixes in per_class.items():
        for which, end in enumerate(ends[name]):
            before = 0
            for prefix in sorted(prefixes):
                if before < end <= before + prefixes[prefix]:
                    wanted.append((name, which, prefix, end - before))
                before += prefixes[prefix]
    cuts = {name: [""] * len(ends[name]) for name in per_class}
    if not wanted:
        return cuts

    groups = sorted({(name, prefix) for name, _, prefix, _ in wanted})
    inside = F.lit(False)
    for name, prefix in groups:
        inside = inside | ((F.col(label) == name) & digest.startswith(prefix))
    grouped = (
        df.filter(inside)
        .groupBy(F.col(label).alias("label"), F.substring(digest, 1, PREFIX_DIGITS).alias("prefix"), digest.alias("digest"))
        .agg(F.count("*").alias("n"))
    )
    ranked = running_sums(grouped, [F.col("digest")], {"upto": "n"}, by=["label", "prefix"])
    # the first digest at which the running count reaches the wanted number of rows
    ends_at = [
        F.min(F.when((F.col("label") == name) & (F.col("prefix") == prefix) & (F.col("upto") >= rows), F.col("digest")))
        for name, _, prefix, rows in wanted
    ]
    found = ranked.agg(*[column.alias(f"cut{i}") for i, column in enumerate(ends_at)]).first()
    for i, (name, which, _, _) in enumerate(wanted):
        cuts[name][which] = found[f"cut{i}"]
    for own in cuts.values():
        # an empty part ends where the part before it does
        for which in range(1, len(own)):
            own[which] = max(own[which - 1 : which + 1])
    return cuts
