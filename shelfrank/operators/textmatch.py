"""Term matching and BM25 over catalog text, from a stored index.

The index holds a posting for every term of every document, with the term's count in each
field and the fields' lengths, and the terms' document frequencies. It is built once per
catalog; matching, scoring and feature logs join it by
term and never read a text. Candidates come from the rarest term of a search only; other
terms are looked up among the candidate's own postings, which are gathered once per document and
only of terms that are asked for, so no list of all documents per common term is joined.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfrank.functions.arrays import with_runs
from shelfrank.functions.text import tokenize
from shelfrank.session import scratch_folder

# fixed values: the search server's defaults for BM25
K1 = 1.2
B = 0.75


def token_column(field: str) -> str:
    return f"{field}_tokens"


def with_tokens(docs: DataFrame, fields: Sequence[str]) -> DataFrame:
    return docs.withColumns({token_column(f): tokenize(F.col(f)) for f in fields})


# -- the index ---------------------------------------------------------------


@dataclass(frozen=True)
class TextIndex:
    """An inverted index over ``fields``.

    ``documents``: key, carried columns, ``len_<field>``. ``postings``: term, ``tf_<field>``
    and the document's columns. ``terms``: term, ``df`` (documents with it), ``df_<field>`` and
    ``df_any`` (of its fullest field). ``totals``: one row, the number of documents ``n`` and
    per field ``n_<field>`` and ``avg_<field>`` over documents in which it is not empty.
    """

    fields: tuple[str, ...]
    key: str
    carry: tuple[str, ...]
    documents: DataFrame
    postings: DataFrame
    terms: DataFrame
    totals: DataFrame
    # postings, and one more row without a term for each document
    entries: DataFrame | None = None

    def total(self) -> Column:
        return self.totals.select(F.struct("*")).scalar()


def index_of(
    docs: DataFrame, fields: Sequence[str], key: str = "sku", carry: Sequence[str] = ()
) -> TextIndex:
    """The index of ``docs``, whose texts may have token columns already."""
    own = [key, *carry, *(f"len_{f}" for f in fields)]
    # only the few documents whose key comes again meet others; the rest are counted where they are read
    repeated = _written(docs.groupBy(F.col(key).alias("_key")).agg(F.count("*").alias("_n")).where("_n > 1"))
    again = F.col(key).eqNullSafe(F.col("_key"))
    counts = [f"tf_{f}" for f in fields]
    merged = (
        _counted(docs.join(repeated, again, "left_semi"), fields, own)
        .groupBy("term", *own)
        .agg(*(F.sum(x).cast("int").alias(x) for x in counts))
    )
    entries = _counted(docs.join(repeated, again, "left_anti"), fields, own).unionByName(merged)
    lengths = [f"len_{f}" for f in fields]
    documents = _with_lengths(docs, fields).select(key, *carry, *lengths)
    postings = entries.where("term IS NOT NULL")
    return _with_statistics(fields, key, carry, documents, postings, entries)


def _written(df: DataFrame) -> DataFrame:
    """``df`` as a table of its own: the planner knows how small it is."""
    path = f"{scratch_folder(df.sparkSession)}/rows"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _with_lengths(docs: DataFrame, fields: Sequence[str]) -> DataFrame:
    missing = [f for f in fields if token_column(f) not in docs.columns]
    docs = with_tokens(docs, missing) if missing else docs
    return docs.withColumns({f"len_{f}": F.size(token_column(f)) for f in fields})


def _counted(docs: DataFrame, fields: Sequence[str], own: Sequence[str]) -> DataFrame:
    """The distinct terms of each row with their counts, and one row without a term."""
    docs = _with_lengths(docs, fields)
    if len(fields) == 1:
        words = F.array_sort(token_column(fields[0]))
    else:
        words = F.array_sort(F.concat(*[_numbered(token_column(f), i) for i, f in enumerate(fields)]))

    def same(a: Column, b: Column) -> Column:
        return a == b if len(fields) == 1 else a["term"] == b["term"]

    def entry(run: Column) -> Column:
        first = F.get(run, 0)
        if len(fields) == 1:
            return F.struct(first.alias("term"), F.size(run).alias(f"tf_{fields[0]}"))
        counts = [_count_of(run, i).alias(f"tf_{f}") for i, f in enumerate(fields)]
        return F.struct(first["term"].alias("term"), *counts)

    none = F.struct(F.lit(None).cast("string").alias("term"), *(F.lit(0).alias(f"tf_{f}") for f in fields))
    runs = with_runs(docs.select(*own, words.alias("_words")), "_words", same, "_runs")
    each = F.explode_outer(F.concat(F.transform("_runs", entry), F.array(none))).alias("_entry")
    return runs.select(*own, each).select("_entry.*", *own)


def _numbered(tokens: str, field: int) -> Column:
    return F.transform(tokens, lambda w: F.struct(w.alias("term"), F.lit(field).alias("field")))


def _count_of(run: Column, field: int) -> Column:
    return F.size(F.filter(run, lambda w: w["field"] == field))


def _with_statistics(
    fields, key, carry, documents: DataFrame, postings: DataFrame, entries: DataFrame | None = None
) -> TextIndex:
    has = [F.sum((F.col(f"tf_{f}") > 0).cast("long")).alias(f"df_{f}") for f in fields]
    terms = (
        postings.groupBy("term")
        .agg(F.count("*").alias("df"), *has)
        .withColumn("df_any", F.greatest(*[F.col(f"df_{f}") for f in fields], F.lit(0)))
    )
    parts = [F.count("*").cast("double").alias("n")]
    for field in fields:
        filled = F.when(F.col(f"len_{field}") > 0, F.col(f"len_{field}"))
        parts.append(F.count(filled).cast("double").alias(f"n_{field}"))
        parts.append(F.avg(filled).alias(f"avg_{field}"))
    totals = documents.agg(*parts)
    return TextIndex(tuple(fields), key, tuple(carry), documents, postings, terms, totals, entries)


def write_index(index: TextIndex, path: str) -> TextIndex:
    """The index as tables under ``path``; texts are read once, statistics come from postings."""
    spark = index.postings.sparkSession
    index.entries.write.mode("overwrite").parquet(f"{path}/entries")
    entries = spark.read.parquet(f"{path}/entries")
    lengths = [f"len_{f}" for f in index.fields]
    stored = _with_statistics(
        index.fields,
        index.key,
        index.carry,
        entries.where("term IS NULL").select(index.key, *index.carry, *lengths),
        entries.where("term IS NOT NULL"),
    )
    stored.terms.write.mode("overwrite").parquet(f"{path}/terms")
    stored.totals.write.mode("overwrite").parquet(f"{path}/totals")
    return read_index(spark, path, index.fields, index.key, index.carry)


def read_index(
    spark: SparkSession, path: str, fields: Sequence[str], key: str = "sku", carry: Sequence[str] = ()
) -> TextIndex:
    entries, terms, totals = (spark.read.parquet(f"{path}/{x}") for x in ("entries", "terms", "totals"))
    documents = entries.where("term IS NULL").select(key, *carry, *(f"len_{f}" for f in fields))
    postings = entries.where("term IS NOT NULL")
    return TextIndex(tuple(fields), key, tuple(carry), documents, postings, terms, totals, entries)


def as_index(
    docs: DataFrame | TextIndex, fields: Sequence[str], key: str, carry: Sequence[str] = ()
) -> TextIndex:
    """``docs`` itself if it is an index that has all that is asked for."""
    if not isinstance(docs, TextIndex):
        return index_of(docs, fields, key, carry)
    lacking = [x for x in fields if x not in docs.fields] + [x for x in carry if x not in docs.carry]
    if lacking or docs.key != key:
        raise ValueError(f"the index of {docs.key!r} lacks {lacking}")
    return docs


# -- scores ------------------------------------------------------------------


def idf(total: Column, df: Column) -> Column:
    return F.log(1 + (total - df + 0.5) / (df + 0.5))


def tf_part(tf: Column, length: Column, average: Column) -> Column:
    return tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / average))


def query_terms(queries: DataFrame, query: str) -> DataFrame:
    """``(query, term, times)`` of each distinct search text."""
    return (
        queries.select(query)
        .distinct()
        .select(query, F.explode(tokenize(F.col(query))).alias("term"))
        .groupBy(query, "term")
        .agg(F.count("*").alias("times"))
    )


def _part(index: TextIndex, field: str, entry: Column, posting: Column | None) -> Column:
    tf = F.col(f"tf_{field}") if posting is None else posting[f"tf_{field}"]
    return tf_part(tf.cast("double"), F.col(f"len_{field}").cast("double"), entry[f"avg_{field}"])


def _scores(index: TextIndex, entry: Column, blended: bool, posting: Column | None = None) -> list[Column]:
    """What a posting, by default the row's own, adds for one term of a search (see ``_weighted``)."""
    if blended:
        best = F.greatest(*[_part(index, f, entry, posting) for f in index.fields], F.lit(0.0))
        return [(entry["times"] * entry["w_any"] * best).alias("match_score")]
    return [
        (entry["times"] * entry[f"w_{f}"] * _part(index, f, entry, posting)).alias(f"bm25_{f}")
        for f in index.fields
    ]


def _weighted(queries: DataFrame, index: TextIndex, query: str) -> DataFrame:
    """``query, entry``: each term of each search with its weights; ``df`` is NULL if unknown."""
    total = F.col("_totals")
    known = {f: F.coalesce(f"df_{f}", F.lit(0)) for f in index.fields}
    entry = F.struct(
        "term",
        "times",
        "df",
        *[idf(total[f"n_{f}"], df).alias(f"w_{f}") for f, df in known.items()],
        idf(total["n"], F.coalesce("df_any", F.lit(0))).alias("w_any"),
        *[F.coalesce(total[f"avg_{f}"], F.lit(1.0)).alias(f"avg_{f}") for f in index.fields],
    )
    return (
        query_terms(queries, query)
        .join(index.terms, "term", "left")
        .withColumn("_totals", index.total())
        .select(query, entry.alias("entry"))
    )


def matched_scores(
    queries: DataFrame,
    docs: DataFrame | TextIndex,
    fields: Sequence[str],
    query: str = "search_term",
    key: str = "sku",
    carry: Sequence[str] = (),
    blended: bool = True,
) -> DataFrame:
    """Documents that have every term of a search, with ``match_score``.

    Per term the better field counts, weighted by the document frequency of its fullest
    field, as a search over several fields scores. Without ``blended`` each field has its
    score instead, ``bm25_<field>``. A search of one term is answered by its postings alone:
    no exchange besides that of the join.
    """
    index = as_index(docs, fields, key, carry)
    scores = ["match_score"] if blended else [f"bm25_{f}" for f in index.fields]
    entries = (
        _weighted(queries, index, query)
        .groupBy(query)
        .agg(
            F.min_by("entry", F.struct("entry.df", "entry.term")).alias("rarest"),
            F.count("entry.df").alias("known"),
            F.collect_list("entry").alias("entries"),
        )
        .filter(F.col("known") == F.size("entries"))
        .select(query, "rarest", F.filter("entries", lambda e: e["term"] != F.col("rarest")["term"]).alias("rest"))
    )
    searched = _written_searches(entries)
    alone = (
        index.postings.join(searched.filter("NOT _more"), F.col("term") == F.col("rarest")["term"])
        .select(query, key, *carry, *_scores(index, F.col("rarest"), blended))
    )
    several = searched.filter("_more").select(query, "rarest", "rest")
    own = [key, *carry, *(f"len_{f}" for f in index.fields)]
    held = _held(index, several, own)

    def found(entry: Column) -> Column:
        return F.get(F.filter("_held", lambda x: x["term"] == entry["term"]), 0)

    candidates = held.select(*own, "_held", F.explode("_first").alias("_hit")).join(
        several, F.col("_hit.term") == F.col("rarest.term")
    )
    lacking = F.array_except(F.col("rest.term"), F.col("_held.term"))
    matched = candidates.filter(F.size(lacking) == 0).withColumn(
        "_pairs", F.transform("rest", lambda e: F.struct(e.alias("entry"), found(e).alias("posting")))
    )

    def others(number: int) -> Column:
        def added(total: Column, pair: Column) -> Column:
            return total + _scores(index, pair["entry"], blended, pair["posting"])[number]

        return F.aggregate("_pairs", F.lit(0.0), added)

    firsts = _scores(index, F.col("rarest"), blended, F.col("_hit"))
    total = [first + others(number) for number, first in enumerate(firsts)]
    return alone.unionByName(
        matched.select(query, key, *carry, *(t.alias(x) for t, x in zip(total, scores, strict=True)))
    )


def _written_searches(searched: DataFrame) -> DataFrame:
    """Searches as a table, those of several terms (``_more``) apart: often they are few."""
    searched = searched.withColumn("_more", F.size("rest") > 0)
    path = f"{scratch_folder(searched.sparkSession)}/searches"
    searched.write.partitionBy("_more").parquet(path)
    return searched.sparkSession.read.schema(searched.schema).parquet(path)


def _held(index: TextIndex, several: DataFrame, own: Sequence[str]) -> DataFrame:
    """Per document with the rarest term of a search: its postings of all terms asked for
    (``_held``), and those of them that are the rarest of a search (``_first``).
    """
    asked = F.concat(
        F.array(F.struct(F.col("rarest.term").alias("term"), F.lit(True).alias("rarest"))),
        F.transform("rest", lambda e: F.struct(e["term"].alias("term"), F.lit(False).alias("rarest"))),
    )
    terms = (
        several.select(F.explode(asked).alias("_asked"))
        .groupBy("_asked.term")
        .agg(F.max("_asked.rarest").alias("_rarest"))
    )
    posting = F.struct("term", *(f"tf_{f}" for f in index.fields), "_rarest")
    return (
        index.postings.filter(F.col(index.key).isNotNull())
        .join(terms, "term")
        .groupBy(*own)
        .agg(F.collect_list(posting).alias("_held"))
        .withColumn("_first", F.filter("_held", lambda x: x["_rarest"]))
        .filter(F.size("_first") > 0)
    )


def exact_keys(queries: DataFrame, index: TextIndex, query: str, carry: Sequence[str] = ()) -> DataFrame:
    """Documents whose whole key is the search text."""
    return (
        queries.select(query)
        .distinct()
        .join(index.documents.select(index.key, *carry), F.col(query) == F.col(index.key).cast("string"))
        .select(query, index.key, *carry)
    )


def match_cross_fields(
    queries: DataFrame,
    docs: DataFrame | TextIndex,
    fields: Sequence[str],
    query: str = "search_term",
    key: str = "sku",
    exact_key: bool = True,
) -> DataFrame:
    """Documents in which every term of the search occurs in one field or another.

    With ``exact_key`` a search text equal to the whole key matches as well (``exact`` is then
    true). Returns ``query, key, exact`` with one row per match.
    """
    index = as_index(docs, fields, key)
    matched = matched_scores(queries, index, fields, query, key).select(query, key, F.lit(False).alias("exact"))
    if not exact_key:
        return matched
    equal = exact_keys(queries, index, query).withColumn("exact", F.lit(True))
    return matched.unionAll(equal).groupBy(query, key).agg(F.max("exact").alias("exact"))


def bm25(
    pairs: DataFrame,
    docs: DataFrame | TextIndex,
    fields: Sequence[str],
    query: str = "search_term",
    key: str = "sku",
    carry: Sequence[str] = (),
) -> DataFrame:
    """BM25 of each field for given (search, document) pairs.

    Adds ``bm25_<field>`` (0 where no term occurs); pairs of unknown documents go. ``carry``
    names document columns to add.
    """
    index = as_index(docs, fields, key, carry)
    terms = _weighted(pairs, index, query).filter(F.col("entry.df").isNotNull())
    counts = [f"{x}_{f}" for f in index.fields for x in ("tf", "len")]
    sums = (
        pairs.select(query, key)
        .distinct()
        .join(terms, query)
        .withColumn("term", F.col("entry.term"))
        .join(index.postings.select("term", key, *counts), ["term", key])
        .select(query, key, *_scores(index, F.col("entry"), False))
        .groupBy(query, key)
        .agg(*[F.sum(f"bm25_{f}").alias(f"bm25_{f}") for f in index.fields])
    )
    return (
        pairs.join(index.documents.select(key, *carry), key)
        .join(sums, [query, key], "left")
        .withColumns({f"bm25_{f}": F.coalesce(f"bm25_{f}", F.lit(0.0)) for f in index.fields})
    )
