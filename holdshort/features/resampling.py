"""Random and synthetic resampling of labelled rows. All draws are hashes of a seed, so they can be repeated."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdshort.features.neighbours import nearest_neighbours
from holdshort.operators.spread import number_rows
from holdshort.session import freeze


def _draw(seed: int, *columns) -> Column:
    """Uniform number in [0, 1) from a seed and some columns."""
    return F.pmod(F.xxhash64(F.lit(seed), *columns), F.lit(2**53)).cast("double") / float(2**53)


def sample_one_per_group(rows: DataFrame, keys: Sequence[str], seed: int = 22) -> DataFrame:
    """One random row per group, chosen by a partial aggregate."""
    row = F.struct(*[F.col(f"`{c}`") for c in rows.columns])
    pick = rows.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(
        F.min(F.struct(F.xxhash64(F.lit(seed), row).alias("_h"), row.alias("_row"))).alias("_m"))
    return pick.select("_m._row.*")


def oversample_to_class(rows: DataFrame, label: str, reference, untouched: Sequence = (), seed: int = 42) -> DataFrame:
    """Redraw every class, with replacement, to the size of the reference class; that class and the untouched ones stay.

    Rows are numbered per class, and drawn numbers are joined to them; only one count per class reaches the driver.
    """
    sizes = {r[0]: r[1] for r in rows.groupBy(label).count().collect()}
    stay = [reference, *untouched]
    redraw = [c for c in sizes if c not in stay and c is not None]
    kept = rows.where(F.col(label).isin(stay))
    if not redraw or not sizes.get(reference):
        return kept
    numbered = number_rows(rows.where(F.col(label).isin(redraw)), [F.xxhash64(*rows.columns), *_sortable(rows)], [label], "_i")
    count_of = F.create_map(*[F.lit(x) for c in redraw for x in (c, sizes[c])])
    draws = rows.sparkSession.range(sizes[reference]).select(
        "id", F.explode(F.array(*[F.lit(c) for c in redraw])).alias(label))
    number = F.pmod(F.xxhash64(F.lit(seed), "id", label), F.element_at(count_of, F.col(label))) + 1
    drawn = draws.select(label, number.alias("_i")).join(numbered, [label, "_i"])
    return kept.unionByName(drawn.select(*rows.columns))


def _sortable(rows):
    return [f"`{f.name}`" for f in rows.schema.fields if not f.dataType.simpleString().startswith(("map", "struct"))
            and f.dataType.typeName() != "udt" and "vector" not in f.dataType.simpleString()]


def smote(rows: DataFrame, label: str, id: str, vector: str, k: int = 5, seed: int = 22) -> DataFrame:
    """Fill every smaller class up to the largest with points between a random row and one of its k nearest of the class.

    Returns (id, label, vector, synthetic). Synthetic rows have negative ids. A class of one row is left alone.
    """
    sizes = {r[0]: r[1] for r in rows.where(F.col(label).isNotNull()).groupBy(label).count().collect()}
    plain = rows.select(id, label, F.col(vector).cast("array<double>").alias(vector))
    out = plain.withColumn("synthetic", F.lit(False))
    largest = max(sizes.values(), default=0)
    small = [c for c, n in sizes.items() if 1 < n < largest]
    if not small:
        return out
    minority = plain.where(F.col(label).isin(small))
    near = nearest_neighbours(minority, k, id, vector, within=label)
    numbered = number_rows(minority, [id], [label], "_i")
    lookup = lambda values: F.element_at(F.create_map(*[F.lit(x) for c in small for x in (c, values[c])]), F.col(label))
    missing = {c: largest - sizes[c] for c in small}
    total = max(missing.values())
    draws = rows.sparkSession.range(total).select(
        F.col("id").alias("_draw"), F.explode(F.array(*[F.lit(c) for c in small])).alias(label))
    draws = draws.where(F.col("_draw") < lookup(missing))
    draws = draws.select(
        label, "_draw",
        (F.pmod(F.xxhash64(F.lit(seed), "_draw", label), lookup(sizes)) + 1).alias("_i"),
        (F.pmod(F.xxhash64(F.lit(seed + 1), "_draw", label), F.least(F.lit(k), lookup(sizes) - 1)) + 1).cast("int").alias("rank"),
        _draw(seed + 2, "_draw", label).alias("_u"))
    code = lookup({c: i for i, c in enumerate(small)})
    base = draws.join(numbered, [label, "_i"]).join(near.select(id, "rank", "neighbour"), [id, "rank"])
    other = minority.select(F.col(id).alias("neighbour"), F.col(vector).alias("_other"))
    between = F.zip_with(vector, "_other", lambda a, b: a + F.col("_u") * (b - a))
    made = base.join(other, "neighbour").select(
        (-(F.col("_draw") * len(small) + code) - 1).cast(rows.schema[id].dataType).alias(id), label,
        between.alias(vector), F.lit(True).alias("synthetic"))
    return out.unionByName(made)


def edited_neighbours(rows: DataFrame, label: str, id: str, vector: str, k: int = 3, unanimous: bool = True) -> DataFrame:
    """Keep rows whose k nearest rows all (or, if not `unanimous`, mostly) have their label."""
    near = nearest_neighbours(rows, k, id, vector)
    theirs = rows.select(F.col(id).alias("neighbour"), F.col(label).alias("_theirs"))
    votes = near.join(theirs, "neighbour").join(rows.select(id, label), id).groupBy(id).agg(
        F.avg((F.col("_theirs") == F.col(label)).cast("double")).alias("_share"))
    agreed = votes.where(F.col("_share") >= 1.0 if unanimous else F.col("_share") > 0.5)
    return rows.join(agreed.select(id), id, "left_semi")


def smote_enn(rows: DataFrame, label: str, id: str, vector: str, k: int = 5, k_edit: int = 3, seed: int = 22) -> DataFrame:
    """Oversample, then remove rows that disagree with their neighbours."""
    return edited_neighbours(freeze(smote(rows, label, id, vector, k, seed)), label, id, vector, k_edit)
