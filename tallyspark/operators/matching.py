"""Names that contain other names, by an index of q-grams.

Texts are matched as such, each distinct one once, and what meets is joined back to the rows that have these texts; so
the index grows with the texts that there are, not with the rows or with how often a text occurs.

A name contains a fragment only if it contains each of the fragment's strings of Q characters (the fragment itself
where it is shorter). Only strings that fragments ask for are indexed. Their occurrences are counted, and each fragment
is looked up by its two rarest strings: by the rarest alone, and, where that one is in more than HOT names,
by both together, so a string that nearly all names have doesn't bring them all to one task unless the second one is as
frequent. A fragment with a string that no name has is dropped before any join. What meets is then tested.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..storage import stored

Q = 4
#: Names in which a string occurs, beyond which it is looked up together with a second one.
HOT = 10_000
#: Pairs of texts that are sent to all tasks, at most.
FEW = 100_000
#: Rows of a text beyond whose product, of fragments and of holdings, they are dealt out in squares of SIDE by SIDE.
SIDE = 2_000
#: Squares that a task gets, about.
SQUARES = 16


def _grams(text: Column, size: Column) -> Column:
    """Distinct strings of ``size`` characters."""
    places = F.when(F.length(text) >= size, F.sequence(F.lit(1), F.length(text) - size + 1)).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(places, lambda i: F.substring(text, i, size)))


def matched_texts(texts: DataFrame, names: DataFrame, hot: int = HOT) -> DataFrame | None:
    """__text, __name: every distinct text of ``texts`` with every distinct one of ``names`` that contains it, stored; None
    without texts, and then names aren't read. Both have one column of these names, in lower case; empty and null ones match
    nothing."""
    asked = stored(texts.where("__text <> ''").distinct(), "fragment-texts")
    grams = stored(asked.select("__text", F.explode(_grams(F.col("__text"), F.least(F.length("__text"), F.lit(Q)))).alias("__gram")), "fragment-strings")
    sizes = sorted(r[0] for r in grams.select(F.length("__gram")).distinct().collect())  # Q rows at most
    if not sizes:
        return None
    named = names.where("__name is not null").distinct()
    every = F.concat(*(_grams(F.col("__name"), F.lit(n)) for n in sizes))
    found = stored(named.select("__name", F.explode(every).alias("__gram")).join(grams.select("__gram").distinct(), "__gram", "left_semi"), "name-strings")

    counts = found.groupBy("__gram").agg(F.count("*").alias("__n"))
    ranked = grams.join(counts, "__gram", "left").groupBy("__text").agg(
        F.min(F.coalesce("__n", F.lit(0))).alias("__least"),
        F.sort_array(F.collect_list(F.struct(F.coalesce("__n", F.lit(0)).alias("n"), "__gram"))).alias("__by_count"),
    )  # a fragment's strings: as many as it has characters at most
    first, second = F.col("__by_count")[0], F.try_element_at("__by_count", F.lit(2))
    lookups = stored(ranked.where("__least > 0").select("__text", first["__gram"].alias("__gram"), F.when(first["n"] > hot, second["__gram"]).alias("__second")), "lookups")

    pairs = lookups.where("__second is null").join(found, "__gram").select("__text", "__name")
    if not lookups.where("__second is not null").isEmpty():
        keys = ["__gram", "__second"]
        two = lookups.where("__second is not null").select(*keys).distinct()
        both = found.join(two.select("__gram").distinct(), "__gram", "left_semi").select("__gram", "__name", F.explode(_grams(F.col("__name"), F.lit(Q))).alias("__second"))
        double = lookups.where("__second is not null").join(both.join(two, keys, "left_semi"), keys)
        pairs = pairs.unionByName(double.select("__text", "__name"))
    return stored(pairs.where(F.col("__name").contains(F.col("__text"))), "matched-texts")


def _holding_texts(pairs: DataFrame, holdings: DataFrame, within: tuple[str, ...]) -> DataFrame:
    """within, __text, holding_id: the texts that each holding's name contains."""
    named = holdings.where("name is not null").select(*within, "holding_id", F.lower("name").alias("__name"))
    return named.join(F.broadcast(pairs) if pairs.count() <= FEW else pairs, "__name").select(*within, "__text", "holding_id")


def _in_squares(asked: DataFrame, held: DataFrame, keys: list[str], side: int) -> tuple[DataFrame, DataFrame]:
    """Both with __i and __j, to be joined by these as well: the rows of a text that many fragments and holdings have are dealt
    out, each side repeated for the other's parts. Few rows may have very many pairs, so the squares say how many tasks
    there are."""
    n = asked.groupBy(*keys).agg(F.count("*").alias("__fs")).join(held.groupBy(*keys).agg(F.count("*").alias("__hs")), keys)
    parts = [F.ceil(F.col(c) / side).cast("int").alias(c) for c in ("__fs", "__hs")]
    many = stored(n.where(F.col("__fs") * F.col("__hs") > side * side).select(*keys, *parts), "frequent-texts")  # a row for side * side pairs at least
    squares = many.agg(F.sum(F.col("__fs").cast("bigint") * F.col("__hs"))).first()[0] or 0
    many = F.broadcast(many)
    nth = lambda by, n: F.pmod(F.xxhash64(by), F.coalesce(n, F.lit(1))).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.coalesce(n, F.lit(1)) - 1))
    dealt = asked.join(many, keys, "left").withColumn("__i", nth("fragment_id", "__fs")).withColumn("__j", each("__hs"))
    others = held.join(many, keys, "left").withColumn("__j", nth("holding_id", "__hs")).withColumn("__i", each("__fs"))
    tasks = max(int(asked.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-squares // SQUARES))
    both = (x.drop("__fs", "__hs") for x in (dealt, others))
    return tuple(x.repartition(tasks, *keys, "__i", "__j") if squares else x for x in both)


def match_names(fragments: DataFrame, holdings: DataFrame, within: tuple[str, ...] = (), hot: int = HOT, side: int = SIDE) -> DataFrame:
    """fragments (fragment_id, fragment, ...) with every holding_id whose name contains the fragment, in any case,
    and that has equal columns ``within``. Empty and null fragments and names match nothing.

    The pairs of texts are stored while the result is built; without fragments, names aren't read.
    """
    asked = fragments.where(F.length("fragment") > 0).withColumn("__text", F.lower("fragment"))
    pairs = matched_texts(asked.select("__text"), holdings.select(F.lower("name").alias("__name")), hot)
    if pairs is None:
        return fragments.where(F.lit(False)).withColumn("holding_id", F.lit(None).cast(holdings.schema["holding_id"].dataType))
    keys = [*within, "__text"]
    asked, held = _in_squares(asked, _holding_texts(pairs, holdings, within), keys, side)
    return asked.join(held, [*keys, "__i", "__j"]).select(*fragments.columns, "holding_id")


#: Characters of a name by which a table's rows find their holdings again.
FRAGMENT = 60


def reassigned(sources: DataFrame, holdings: DataFrame, size: int = FRAGMENT) -> DataFrame:
    """doc_id, table_idx, row_idx, holding_id: for every row of a table (doc_id, table_idx, row_idx, name) the holdings of
    its document whose names contain the first ``size`` characters of the row's name, in any case.

    A holding belongs to as many rows as name it, in its own table and in others. Each text is looked up once.
    """
    rows = sources.select("doc_id", "table_idx", "row_idx", F.lower(F.trim(F.substring("name", 1, size))).alias("__text")).where("__text <> ''")
    pairs = matched_texts(rows.select("__text"), holdings.select(F.lower("name").alias("__name")))
    if pairs is None:
        return rows.where(F.lit(False)).select("doc_id", "table_idx", "row_idx", F.lit(None).cast(holdings.schema["holding_id"].dataType).alias("holding_id"))
    return rows.join(_holding_texts(pairs, holdings, ("doc_id",)), ["doc_id", "__text"]).select("doc_id", "table_idx", "row_idx", "holding_id")
