"""A stored index for the search page: questions ranked in blocks, and postings by block.

Results come in one order, whatever the query: best score first, then id. So questions are
stored by rank, and the postings of a gram say, for each block of ``BLOCK`` ranks it occurs in,
where in the block. A search reads the best blocks first, only the buckets of its grams and only
the row groups of these blocks, looks into the texts of the questions that hold all grams, a
page of ranks at a time, and ends when it has enough: all later ones have lower scores.

Building is one batch job. Ranks come from a sort in ranges over all tasks. Texts are then dealt
by block, so that a block's grams meet in the task that finds them and only postings, not single
grams, are shuffled. A gram that every question has is one row a block, of at most ``BLOCK``
places, so no group grows with the table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tagpulse.operators.serving import GRAM, RESULT_COLUMNS, SEARCH_LIMIT, gram_index, matches, tagged

BLOCK = 1024
BUCKETS = 64
#: Blocks that a search reads first; each further step reads so many times more.
FIRST_BLOCKS, GROWTH = 4, 4
#: Questions whose texts are looked into at once, for each result that is wanted; as many more
#: in each further page.
PER_RESULT = 3
POSTINGS = "term string, block bigint, places array<int>, bucket int"
TERMS = "term string, first_block bigint, blocks bigint, questions bigint, bucket int"
#: Blocks whose postings of a bucket are written by one task.
TOGETHER = 256
#: monotonically_increasing_id: the partition stands above this many bits.
_ROW_BITS = 33


def build(questions: DataFrame, path: str, *, block: int = BLOCK, buckets: int = BUCKETS) -> SearchIndex:
    """Write the index of ``questions``, all columns of theirs, to the new folder ``path``."""
    spark = questions.sparkSession
    order = [F.desc("score"), F.asc("question_id")]
    # A first write fixes the ranges: what follows must see the same ones, executors lost or not.
    placed = questions.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    placed.write.parquet(f"{path}/placed")
    placed = spark.read.parquet(f"{path}/placed")
    part = F.shiftright("at", _ROW_BITS)
    # A row for each range: few, however many questions there are.
    sizes = placed.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    rank = F.col("before") + F.expr(f"at & {(1 << _ROW_BITS) - 1}L")
    ranked = (
        placed.withColumn("part", part)
        .join(before, "part")
        .select(rank.alias("rank"), *questions.columns)
    )
    ranked.repartitionByRange("rank").sortWithinPartitions("rank").write.parquet(f"{path}/ranked")

    # The rank takes the part of the id, so grams need no join.
    texts = spark.read.parquet(f"{path}/ranked").select(
        F.col("rank").alias("question_id"), "title", "body", F.expr(f"rank DIV {block}").alias("block")
    )
    grams = gram_index(texts.repartition("block"), "block").select(
        F.col("gram").alias("term"), "block", F.expr(f"CAST(question_id % {block} AS INT)").alias("place")
    )
    postings = grams.groupBy("term", "block").agg(F.sort_array(F.collect_list("place")).alias("places"))
    _by_term(postings, buckets, F.expr(f"block DIV {TOGETHER}"), "block").write.partitionBy("bucket").parquet(f"{path}/postings")
    terms = spark.read.schema(POSTINGS).parquet(f"{path}/postings").groupBy("term").agg(
        F.min("block").alias("first_block"), F.count("*").alias("blocks"), F.sum(F.size("places")).alias("questions")
    )
    _by_term(terms, buckets).write.partitionBy("bucket").parquet(f"{path}/terms")
    return SearchIndex(spark, path, block=block, buckets=buckets)


def _bucket(term: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(buckets)).cast("int")


def _by_term(rows: DataFrame, buckets: int, dealt: Column | None = None, *then: str) -> DataFrame:
    # By hash, as ranges would be found by computing all rows once more.
    placed = rows.withColumn("bucket", _bucket(F.col("term"), buckets))
    by = ["bucket"] if dealt is None else ["bucket", dealt]
    return placed.repartition(*by).sortWithinPartitions("bucket", "term", *then)


class SearchIndex:
    """An index that :func:`build` wrote."""

    def __init__(self, spark: SparkSession, path: str, *, block: int = BLOCK, buckets: int = BUCKETS):
        self.ranked = spark.read.parquet(f"{path}/ranked")
        self.postings, self.terms = (spark.read.schema(s).parquet(f"{path}/{n}") for n, s in (("postings", POSTINGS), ("terms", TERMS)))
        self.block, self.buckets = block, buckets
        last = self.ranked.agg(F.max("rank")).first()[0]  # from the footers of the files
        self.blocks = 0 if last is None else last // block + 1

    def of_terms(self, rows: DataFrame, terms: Sequence[str]) -> DataFrame:
        """The rows of ``rows`` (postings or terms) that are about ``terms``."""
        # As few literals as the query has grams; folded, so that they prune partitions.
        buckets = [_bucket(F.lit(term), self.buckets) for term in terms]
        return rows.filter(F.col("bucket").isin(*buckets) & F.col("term").isin(*terms))

    def candidates(self, terms: Sequence[str], start: int, end: int) -> DataFrame:
        """Ranks of the questions of blocks ``start`` to ``end`` (without it) that hold all of
        ``terms``."""
        held = self.of_terms(self.postings, terms).filter((F.col("block") >= start) & (F.col("block") < end))
        together = held.groupBy("block").agg(F.collect_list("places").alias("lists"), F.count("*").alias("n"))
        common = F.aggregate("lists", F.col("lists")[0], F.array_intersect)
        places = together.filter(F.col("n") == len(terms)).select("block", F.explode(common).alias("place"))
        return places.select((F.col("block") * self.block + F.col("place")).alias("rank"))

    def search(
        self,
        query: str,
        tags: Sequence[str] = (),
        limit: int = SEARCH_LIMIT,
        every_tag: bool = False,
        columns: Sequence[str] = RESULT_COLUMNS,
    ) -> DataFrame:
        """What :func:`tagpulse.operators.serving.search` finds. Words shorter than a gram
        prune nothing; a query of such words reads the ranked questions alone."""
        wanted = matches(query)
        if tags:
            wanted = tagged(tags, every_tag) & wanted
        terms = sorted({w[i : i + GRAM] for w in query.lower().split() for i in range(len(w) - GRAM + 1)})
        find = self._in_pages if terms else self._in_texts
        found, start, steps = [], 0, FIRST_BLOCKS
        while start < self.blocks and len(found) < limit:
            now = find(terms, wanted, start, start + steps, limit - len(found))
            found, start, steps = found + now, start + steps, steps * GROWTH
            if terms and not now and start < self.blocks:  # rare ones: where do they begin?
                known = self.of_terms(self.terms, terms).agg(F.count("*").alias("n"), F.max("first_block").alias("first")).first()
                start = max(start, known.first) if known.n == len(terms) else self.blocks
        # At most as many ranks as the page shows.
        return self.ranked.filter(F.col("rank").isin(found)).orderBy("rank").select(*columns)

    def _in_texts(self, terms: Sequence[str], wanted: Column, start: int, end: int, limit: int) -> list[int]:
        first, after = start * self.block, end * self.block
        texts = self.ranked.filter((F.col("rank") >= first) & (F.col("rank") < after)).filter(wanted)
        return [row.rank for row in texts.select("rank").orderBy("rank").limit(limit).collect()]

    def _in_pages(self, terms: Sequence[str], wanted: Column, start: int, end: int, limit: int) -> list[int]:
        found, last, candidates = [], -1, self.candidates(terms, start, end)
        size = limit
        while len(found) < limit:
            size *= PER_RESULT
            page = [row.rank for row in candidates.filter(F.col("rank") > last).orderBy("rank").limit(size).collect()]
            if page:
                texts = self.ranked.filter(F.col("rank").between(page[0], page[-1]) & F.col("rank").isin(page)).filter(wanted)
                found += sorted(row.rank for row in texts.select("rank").collect())
            if len(page) < size:
                break
            last = page[-1]
        return found[:limit]
