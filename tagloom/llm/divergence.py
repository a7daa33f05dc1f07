"""How far the sources of a language are from each other, and by which terms.

Terms are counted with Arrow's compute functions inside the tasks: lower case,
split, dictionary and hash grouping, a batch at a time, merged and handed on as
partial counts of (language, source, term). The kept terms of a language are cut
into columnar shards, tables of terms by sources, and every shard adds its part
to the distances of the sources. All numbers are integers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import arrow_schema, batch_of, map_batches
from tagloom.operators.joins import lookup_join
from tagloom.operators.ordering import top_n_per_group
from tagloom.session import materialised

LEAST_DOCS = 30
TOP_TERMS = 50
SMOOTHING = 5
UNIT = 1_000_000_000
BETWEEN = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"  # what is no part of a term

PARTIAL_ROWS = 300_000  # partial counts that a task holds
SHARD_CELLS = 2_000_000  # cells of a shard, terms by sources, about
BLOCK_SOURCES = 256  # sources of one side of a shard, about

COUNTS = "lang string, source string, term string, n long, docs long"
PARTS = "lang string, a string, b string, value long, gap long, v long"


def count_batch(batch: pa.RecordBatch) -> pa.Table:
    """``COUNTS`` of one batch; a row with a null term stands for each (language, source) and counts its texts."""
    lang, source = (batch.column(c).dictionary_encode() for c in ("lang", "source"))
    pieces = pc.split_pattern_regex(pc.ascii_lower(batch.column("text")), pattern=BETWEEN)
    doc, piece = pc.list_parent_indices(pieces), pc.list_flatten(pieces)
    filled = pc.not_equal(piece, "")
    doc, term = doc.filter(filled), piece.filter(filled).dictionary_encode()
    by_doc = pa.table({"doc": doc, "term": term.indices}).group_by(["doc", "term"], use_threads=False).aggregate([([], "count_all")])
    own = by_doc.column("doc").combine_chunks()
    keyed = pa.table({"lang": lang.indices.take(own), "source": source.indices.take(own), "term": by_doc.column("term").combine_chunks(),
                      "n": by_doc.column("count_all").combine_chunks()})
    counted = keyed.group_by(["lang", "source", "term"], use_threads=False).aggregate([("n", "sum"), ("n", "count")])
    texts = pa.table({"lang": lang.indices, "source": source.indices}).group_by(["lang", "source"], use_threads=False).aggregate([([], "count_all")])

    def named(table: pa.Table, terms: pa.Array, n: pa.Array, docs: pa.Array) -> pa.Table:
        columns = [lang.dictionary.take(table.column("lang").combine_chunks()), source.dictionary.take(table.column("source").combine_chunks()),
                   terms, n.cast(pa.int64()), docs.cast(pa.int64())]
        return pa.Table.from_arrays(columns, schema=arrow_schema(COUNTS))

    return pa.concat_tables([
        named(counted, term.dictionary.take(counted.column("term").combine_chunks()), counted.column("n_sum").combine_chunks(),
              counted.column("n_count").combine_chunks()),
        named(texts, pa.nulls(texts.num_rows, pa.string()), pa.array(np.zeros(texts.num_rows, np.int64)), texts.column("count_all").combine_chunks())])


def merged(tables: list[pa.Table]) -> pa.Table:
    grouped = pa.concat_tables(tables).group_by(["lang", "source", "term"], use_threads=False).aggregate([("n", "sum"), ("docs", "sum")])
    return pa.Table.from_arrays([grouped.column(c) for c in ("lang", "source", "term", "n_sum", "docs_sum")], schema=arrow_schema(COUNTS))


def _partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, rows = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(count_batch(batch))
        rows += held[-1].num_rows
        if rows > PARTIAL_ROWS:
            held = [merged(held)]
            rows = held[0].num_rows
            if 2 * rows > PARTIAL_ROWS:
                yield from held[0].to_batches()
                held, rows = [], 0
    if held:
        yield from merged(held).to_batches()


def term_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """``COUNTS`` of all texts."""
    columns = {"text": text_col, "lang": lang_col, "source": source_col}
    rows = docs.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(name) for name, c in columns.items()])
    partial = map_batches(rows, _partial, COUNTS)
    return partial.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(count: Column, total: Column, terms: Column) -> Column:
    """The smoothed share in whole billionths; decimals of 38 digits keep the product exact."""
    above = (F.lit(UNIT).cast("decimal(10,0)") * (count + SMOOTHING).cast("decimal(28,0)")).cast("decimal(38,0)")
    below = (total + SMOOTHING * terms).cast("decimal(38,0)")
    return F.lit(1).cast("long") + F.call_function("div", above, below)


def _shard(key: tuple[pa.Scalar, ...], shares: pa.Table, groups: pa.Table) -> pa.Table:
    """What the terms of a shard add to the distance of every two sources of its blocks, beyond that of an absent term."""
    lang, _, x, y = (k.as_py() for k in key)
    groups = groups.sort_by("source")
    names, blocks = groups.column("source").combine_chunks(), groups.column("block").to_numpy()
    absent = groups.column("absent").to_numpy()
    v = groups.column("v")[0].as_py() if groups.num_rows else 0
    term = shares.column("term").combine_chunks().dictionary_encode()
    at = pc.index_in(shares.column("source").combine_chunks(), names).to_numpy(zero_copy_only=False).astype(np.int64)
    table = np.repeat(absent[:, None], len(term.dictionary), 1)
    table[at, term.indices.to_numpy(zero_copy_only=False)] = shares.column("p").to_numpy()
    left, right = np.flatnonzero(blocks == x), np.flatnonzero(blocks == y)
    out = []
    for i in left:
        others = right[right > i] if x == y else right
        gap = np.abs(absent[others] - absent[i])
        value = np.abs(table[others] - table[i]).sum(1) - gap * table.shape[1]
        out.append((np.full(len(others), i), others, value, gap))
    empty = np.zeros(0, np.int64)
    a, b, value, gap = (np.concatenate(c) for c in zip((empty,) * 4, *out))
    columns = [pa.array([lang] * len(a), pa.string()), names.take(pa.array(a)), names.take(pa.array(b)), value, gap, np.full(len(a), v)]
    return pa.Table.from_batches([batch_of(arrow_schema(PARTS), columns)])


def source_pairs(shares: DataFrame, groups: DataFrame, cells: int = SHARD_CELLS, block_sources: int = BLOCK_SOURCES) -> DataFrame:
    """``(lang, source, item, value)`` for every two sources of a language.

    ``shares`` holds the shares ``p`` of occurring terms, ``groups`` every (language, source) with the number of its language's
    terms (``v``) and sources and the share of an ``absent`` term. Terms are dealt to shards of a bounded number of cells,
    sources to blocks of a bounded number, and every two blocks meet in every shard.
    """
    n_blocks = F.ceil(F.col("sources") / F.lit(float(block_sources)))
    n_shards = F.ceil(F.greatest(F.col("v") * F.least("sources", F.lit(2 * block_sources)), F.lit(1)) / F.lit(float(cells)))
    sized = materialised(groups.withColumn("n_blocks", n_blocks).withColumn("n_shards", n_shards), "groups")

    def blocked(rows: DataFrame) -> DataFrame:
        block = F.pmod(F.xxhash64("source"), "n_blocks")
        rows = rows.withColumn("block", block).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_blocks") - 1)))
        return rows.withColumn("x", F.least("block", "other")).withColumn("y", F.greatest("block", "other"))

    keyed = shares.withColumn("_at", F.struct("lang", "source"))
    sizes = sized.select(F.struct("lang", "source").alias("_group"), "n_blocks", "n_shards")
    left = blocked(lookup_join(keyed, sizes, "_at", "_group", "inner", ["term"])).select(
        "lang", F.pmod(F.xxhash64("term"), "n_shards").alias("shard"), "x", "y", "source", "term", "p")
    right = blocked(sized).withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_shards") - 1))).select(
        "lang", "shard", "x", "y", "source", "block", "absent", "v")
    key = ["lang", "shard", "x", "y"]
    parts = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(_shard, PARTS)
    summed = parts.groupBy("lang", "a", "b").agg(F.sum("value").alias("beyond"), F.max("gap").alias("gap"), F.max("v").alias("v"))
    value = (F.col("beyond") + F.col("gap") * F.col("v")).alias("value")
    both = F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item"))))
    return summed.select("lang", both.alias("p"), value).select("lang", "p.source", "p.item", "value")


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP_TERMS, text_col: str = "text", lang_col: str = "lang",
          source_col: str = "source") -> DataFrame:
    """Ranked distances of each source to the others of its language (``pair``) and the terms it has too many of (``term``).

    Null texts, languages and sources are empty ones; an empty source is a source like any other. A language without kept terms
    has pairs of value 0 and no terms; a source alone in its language has no pairs. Repeated rows count as often as they occur,
    ties are ranked by the item's bytes, an empty table gives no rows, further columns are ignored.
    """
    counts = materialised(term_counts(docs, text_col, lang_col, source_col), "term-counts")
    kept = counts.where("term is not null").groupBy("lang", "term").agg(F.sum("docs").alias("in_docs"), F.sum("n").alias("n_all"))
    kept = materialised(kept.where(F.col("in_docs") >= least_docs).select(F.col("lang").alias("_lang"), F.col("term").alias("_term"), "n_all"), "kept-terms")
    own = counts.join(kept, (F.col("lang") == F.col("_lang")) & (F.col("term") == F.col("_term"))).select("lang", "source", "term", "n", "n_all")
    own = materialised(own, "kept-counts")
    of_lang = kept.groupBy(F.col("_lang").alias("_of")).agg(F.count("*").alias("v"), F.sum("n_all").alias("lang_total"))
    sources = counts.where("term is null").select("lang", "source")
    number = sources.groupBy(F.col("lang").alias("_of")).agg(F.count("*").alias("sources"))
    total = own.groupBy(F.struct("lang", "source").alias("_of")).agg(F.sum("n").alias("total"))
    groups = lookup_join(lookup_join(sources, of_lang, "lang", "_of", "left", ["source"]), number, "lang", "_of", "inner", ["source"])
    groups = lookup_join(groups.withColumn("_at", F.struct("lang", "source")), total, "_at", "_of", "left", ["source"]).drop("_at")
    groups = groups.fillna(0, ["v", "lang_total", "total"])
    absent = F.when(F.col("v") > 0, share(F.lit(0), F.col("total"), F.greatest("v", F.lit(1)))).otherwise(F.lit(0).cast("long"))
    groups = materialised(groups.withColumn("absent", absent), "groups")

    sizes = groups.select(F.struct("lang", "source").alias("_group"), "v", "total", "lang_total")
    shares = lookup_join(own.withColumn("_at", F.struct("lang", "source")), sizes, "_at", "_group", "inner", ["term"]).select(
        "lang", "source", "term", share(F.col("n"), F.col("total"), F.col("v")).alias("p"),
        share(F.col("n_all"), F.col("lang_total"), F.col("v")).alias("q"))
    shares = materialised(shares, "shares")
    over = shares.where("p > q").select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    order = [F.desc("value"), F.asc("item")]
    terms = top_n_per_group(over, ["lang", "source"], order, top, "rank").withColumn("part", F.lit("term"))
    pairs = source_pairs(shares.select("lang", "source", "term", "p"), groups.select("lang", "source", "sources", "v", "absent"))
    # A group of pairs is as large as the number of sources, each with a row of its own in the result.
    pairs = top_n_per_group(pairs, ["lang", "source"], order, 2 ** 31 - 1, "rank").withColumn("part", F.lit("pair"))
    columns = ["lang", "source", "part", "item", "value", F.col("rank").cast("int").alias("rank")]
    return pairs.select(*columns).unionByName(terms.select(*columns))


ORACLE = rf"""
WITH docs AS (SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '{BETWEEN}'), lambda w: w <> '') AS words FROM documents),
  used AS (SELECT lang, source, unnest(words) AS term FROM docs),
  seen AS (SELECT lang, unnest(list_distinct(words)) AS term FROM docs),
  kept AS (SELECT lang, term FROM seen GROUP BY ALL HAVING count(*) >= {LEAST_DOCS}),
  counts AS (SELECT lang, source, term, count(*) AS n FROM used JOIN kept USING (lang, term) GROUP BY ALL),
  groups AS (SELECT DISTINCT lang, source FROM docs),
  of_lang AS (SELECT lang, term, sum(n) AS n FROM counts GROUP BY ALL),
  lang_total AS (SELECT lang, count(*) AS v, sum(n) AS total FROM of_lang GROUP BY ALL),
  totals AS (SELECT lang, source, sum(n) AS total FROM counts GROUP BY ALL),
  shares AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
      1 + (CAST({UNIT} AS HUGEINT) * (coalesce(c.n, 0) + {SMOOTHING})) // (coalesce(t.total, 0) + {SMOOTHING} * l.v) AS p,
      1 + (CAST({UNIT} AS HUGEINT) * (o.n + {SMOOTHING})) // (l.total + {SMOOTHING} * l.v) AS q
    FROM groups g JOIN kept k ON k.lang = g.lang JOIN lang_total l ON l.lang = g.lang JOIN of_lang o ON o.lang = g.lang AND o.term = k.term
    LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
    LEFT JOIN totals t ON t.lang = g.lang AND t.source = g.source),
  pairs AS (SELECT a.lang, a.source, b.source AS item, coalesce(s.value, 0) AS value
    FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN (SELECT x.lang, x.source, y.source AS item, sum(abs(x.p - y.p)) AS value
      FROM shares x JOIN shares y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL) s
      ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
  terms AS (SELECT lang, source, term AS item, p - q AS value FROM shares WHERE n > 0 AND p > q)
SELECT lang, source, 'pair' AS part, item, CAST(value AS BIGINT) AS value,
    CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INTEGER) AS rank FROM pairs
UNION ALL
SELECT lang, source, 'term' AS part, item, CAST(value AS BIGINT) AS value,
    CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INTEGER) AS rank FROM terms
QUALIFY rank <= {TOP_TERMS}"""
