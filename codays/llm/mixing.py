"""Mix sources to target weights with whole blocks of equal size.

Targets share the size of the whole corpus among the sources by weight, and no
source is asked for more than ``most_repeats`` times what it has. Blocks of
``block_words`` words are apportioned by the Sainte-Laguë method: the next
block goes to the largest quotient ``votes / (2 k + 1)``, first among sources,
then among the shards of each source. Every shard then knows an integer quota
and takes its blocks on its own.

A shard is a seeded hash range of one source's documents, laid out in seeded
order and cut into blocks of equal size, which may span documents. A quota of
``q`` blocks out of ``n`` takes the shard ``q div n`` times in whole and spreads
the rest evenly over the blocks from a seeded start, so what a document gives
follows from where it begins and ends; no row is made per block.

Only (id, size, source) rows are shuffled. A source with a third of the corpus
has a third of the shards, so no task gets a whole source. Sums are combined
before the shuffle; windows over sources see one row per source.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from codays.llm.common import WORD_PATTERN, text_of
from codays.session import staged

WEIGHTS = (5, 2, 1)
MOST_REPEATS = 3
BLOCK_WORDS = 64
WORDS_PER_SHARD = 2_000_000
SEED = "mix-1"


def text_size(column: str = "text") -> Column:
    """Words in the text; null and empty texts have none."""
    return F.regexp_count(text_of(column), F.lit(WORD_PATTERN)).cast("long")


def source_targets(
    sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most_repeats: int = MOST_REPEATS
) -> DataFrame:
    """source, source_size, weight, target from rows of (source, size).

    Weights repeat along the sources in code point order, null last. Resharing
    an excess until none is left ends where every source gets its cap or one
    common level times its weight; that level is found by going through the
    sources in the order in which they reach their caps.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    weight = F.element_at(F.array(*map(F.lit, weights)), (turn + 1).cast("int"))
    ranked = sources.withColumn("weight", weight.cast("long")).withColumn(
        "cap", F.col("source_size") * most_repeats
    )
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    after = by_cap.rowsBetween(0, Window.unboundedFollowing)
    whole = Window.partitionBy()
    level = (F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(before), F.lit(0))) / (
        F.sum("weight").over(after)
    )
    levels = ranked.withColumn("level", level)
    holds = F.col("level") * F.col("weight") <= F.col("cap")
    common = F.max(F.when(holds, F.col("level"))).over(whole)
    target = F.least(F.col("cap").cast("double"), common * F.col("weight"))
    return levels.select("source", "source_size", "weight", target.alias("target"))


def apportion(
    parties: DataFrame, group: list[str], party: str, votes: str, total: str, seats: str, out: str
) -> DataFrame:
    """Add ``out``: the Sainte-Laguë seats of each party among the ``seats`` of its group.

    ``total`` is the sum of votes in the group. With divisors a little larger and
    a little smaller than the fair one, at most and at least all seats are given
    away, so only the quotients in between, a few per party, have to be ranked.
    Equal quotients go to the earlier party.
    """
    whole = Window.partitionBy(*group)
    sized = parties.withColumn("_parties", F.count(F.lit(1)).over(whole))
    per_vote = F.when(F.col(total) > 0, F.col(votes) / F.col(total)).otherwise(F.lit(0.0))
    slack = F.col("_parties") / 2
    low = F.greatest(F.lit(0), F.ceil(per_vote * (F.col(seats) - slack) - 0.5) - 1)
    high = F.floor(per_vote * (F.col(seats) + slack) + 0.5) + 1
    bounded = sized.withColumn("_low", F.when(F.col(votes) > 0, low).otherwise(F.lit(0)).cast("long"))
    bounded = bounded.withColumn("_high", F.when(F.col(votes) > 0, high).otherwise(F.lit(0)).cast("long"))
    bounded = bounded.withColumn("_open", F.col(seats) - F.sum("_low").over(whole))
    steps = F.when(
        F.col("_high") > F.col("_low"), F.sequence(F.col("_low"), F.col("_high") - 1)
    ).otherwise(F.array().cast("array<bigint>"))
    offers = bounded.select("*", F.explode_outer(steps).alias("_k"))
    quotient = F.col(votes) / (2 * F.col("_k") + 1)
    order = Window.partitionBy(*group).orderBy(
        quotient.desc_nulls_last(), F.col(party).asc_nulls_last(), F.col("_k")
    )
    won = F.col("_k").isNotNull() & (F.row_number().over(order) <= F.col("_open"))
    kept = [c for c in parties.columns]
    return (
        offers.withColumn("_won", F.when(won, 1).otherwise(0))
        .groupBy(*kept, "_low")
        .agg(F.sum("_won").alias("_more"))
        .select(*kept, (F.col("_low") + F.col("_more")).alias(out))
    )


def draw(*parts: Column) -> Column:
    """A seeded 60-bit number that any engine with md5 can repeat."""
    key = F.concat_ws("|", F.lit(SEED), *[F.coalesce(p.cast("string"), F.lit("~")) for p in parts])
    return F.conv(F.substring(F.md5(F.encode(key, "utf-8")), 1, 15), 16, 10).cast("long")


def _chosen_words(position: str) -> str:
    """SQL: words of partly chosen blocks that lie before a position of the shard.

    The first ``longer`` of the shard's ``blocks`` have ``word_count + 1`` words,
    the others ``word_count``. Block j is chosen where
    ``(j + shift) * chosen div blocks`` rises.
    """
    block = (
        f"CASE WHEN word_count = 0 THEN 0L"
        f" WHEN {position} < longer * (word_count + 1) THEN {position} div (word_count + 1)"
        f" ELSE longer + ({position} - longer * (word_count + 1)) div word_count END"
    )

    def before(j: str) -> str:
        return f"((({j}) + shift) * chosen div blocks - shift * chosen div blocks)"

    inside = f"{position} - ({block}) * word_count - least({block}, longer)"
    taken = f"({before(f'({block}) + 1')} - {before(block)})"
    return f"{before(block)} * word_count + {before(f'least({block}, longer)')} + {taken} * ({inside})"


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    most_repeats: int = MOST_REPEATS,
    block_words: int = BLOCK_WORDS,
    words_per_shard: int = WORDS_PER_SHARD,
) -> DataFrame:
    """doc_id, size, source, source_size, target, taken: a row per row of ``docs``.

    Null and empty texts have size 0 and give nothing; null ids and sources are
    ordinary values; repeated rows are documents of their own; an empty table
    gives no rows. Columns other than doc_id, text and source are not read.
    """
    # Sizes are read twice, so the texts are measured once and the sizes kept.
    sized = staged(docs.select("doc_id", "source", text_size().alias("size")), "sizes")
    whole = Window.partitionBy()
    sources = (
        source_targets(sized, weights, most_repeats)
        .withColumn("corpus_size", F.sum("source_size").over(whole))
        .withColumn("corpus_blocks", F.round(F.col("corpus_size") / block_words).cast("long"))
    )
    sources = apportion(
        sources, [], "source", "target", "corpus_size", "corpus_blocks", "source_blocks"
    ).select(
        F.col("source").alias("of_source"),
        "source_size",
        "target",
        "source_blocks",
        F.greatest(F.lit(1), F.ceil(F.col("source_size") / words_per_shard)).cast("long").alias("shards"),
    )
    shard = Window.partitionBy("source", "shard")
    in_order = shard.orderBy("draw", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = (
        sized.withColumn("draw", draw(F.col("doc_id")))
        .join(sources, F.col("source").eqNullSafe(F.col("of_source")))
        .withColumn("shard", F.col("draw") % F.col("shards"))
        .withColumn("shard_size", F.sum("size").over(shard))
        .withColumn("start", F.coalesce(F.sum("size").over(in_order), F.lit(0)).cast("long"))
    )
    shards = placed.groupBy("source", "shard", "source_size", "source_blocks", "shard_size").agg(
        F.count(F.lit(1)).alias("documents")
    )
    quotas = apportion(
        shards, ["source"], "shard", "shard_size", "source_size", "source_blocks", "quota"
    )
    blocks = F.greatest(F.lit(1), F.round(F.col("shard_size") / block_words)).cast("long")
    quotas = (
        quotas.withColumn("blocks", blocks)
        .withColumn("quota", F.least(F.col("quota"), F.col("blocks") * most_repeats))
        .selectExpr(
            "source AS shard_source",
            "shard AS shard_number",
            "blocks",
            "quota div blocks AS whole_times",
            "quota % blocks AS chosen",
            "shard_size div blocks AS word_count",
            "shard_size % blocks AS longer",
        )
        .withColumn("shift", draw(F.col("shard_source"), F.col("shard_number")) % F.col("blocks"))
    )
    return (
        placed.join(
            quotas,
            F.col("source").eqNullSafe(F.col("shard_source"))
            & (F.col("shard") == F.col("shard_number")),
        )
        .withColumn("stop", F.col("start") + F.col("size"))
        .selectExpr(
            "doc_id",
            "size",
            "source",
            "source_size",
            "target",
            f"whole_times * size + ({_chosen_words('stop')}) - ({_chosen_words('start')}) AS taken",
        )
    )


def mixture(docs: DataFrame) -> DataFrame:
    """What the registered query returns."""
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken")


def mixture_sql(documents: str = "documents") -> str:
    """The same mixture in DuckDB SQL."""

    def digits(*parts: str) -> str:
        key = " || '|' || ".join(f"coalesce(CAST({p} AS VARCHAR), '~')" for p in parts)
        return f"CAST('0x' || substr(md5('{SEED}|' || {key}), 1, 15) AS BIGINT)"

    def seats(rows: str, group: str, party: str, votes: str, total: str, wanted: str, out: str) -> str:
        by = f"PARTITION BY {group}" if group else ""
        share = f"CASE WHEN {total} > 0 THEN {votes} / {total} ELSE 0 END"
        return f"""
          SELECT * EXCLUDE (k, lo, hi, won), CAST(max(lo) + sum(won) AS BIGINT) AS {out} FROM (
            SELECT * EXCLUDE (left_over),
              CASE WHEN k IS NOT NULL AND row_number() OVER ({by}
                ORDER BY {votes} / (2 * k + 1) DESC NULLS LAST, {party} NULLS LAST, k) <= left_over
                THEN 1 ELSE 0 END AS won
            FROM (
              SELECT b.*, g.k FROM (
                SELECT *, {wanted} - sum(lo) OVER ({by}) AS left_over FROM (
                  SELECT *,
                    CASE WHEN {votes} > 0 THEN CAST(greatest(0,
                      ceil(({share}) * ({wanted} - count(*) OVER ({by}) / 2) - 0.5) - 1) AS BIGINT) ELSE 0 END AS lo,
                    CASE WHEN {votes} > 0 THEN CAST(
                      floor(({share}) * ({wanted} + count(*) OVER ({by}) / 2) + 0.5) + 1 AS BIGINT) ELSE 0 END AS hi
                  FROM {rows})) b
              LEFT JOIN LATERAL (SELECT unnest(range(b.lo, b.hi)) AS k) g ON true))
          GROUP BY ALL"""

    def block(at: str) -> str:
        return (
            f"(CASE WHEN word_count = 0 THEN 0"
            f" WHEN {at} < longer * (word_count + 1) THEN {at} // (word_count + 1)"
            f" ELSE longer + ({at} - longer * (word_count + 1)) // word_count END)"
        )

    def before(j: str) -> str:
        return f"((({j}) + shift) * chosen // blocks - shift * chosen // blocks)"

    def words(at: str) -> str:
        j = block(at)
        return (
            f"({before(j)} * word_count + {before(f'least({j}, longer)')}"
            f" + ({before(j + ' + 1')} - {before(j)}) * ({at} - {j} * word_count - least({j}, longer)))"
        )

    return f"""
    WITH sized AS (
      SELECT doc_id, source,
        CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
      FROM {documents}),
    named AS (
      SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
        CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3
          WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
      FROM sized GROUP BY source),
    levels AS (
      SELECT *, {MOST_REPEATS} * source_size AS cap,
        (sum(source_size) OVER () - coalesce(sum({MOST_REPEATS} * source_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
        / sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
      FROM named WINDOW o AS (ORDER BY {MOST_REPEATS} * source_size / weight, source NULLS LAST)),
    targets AS (
      SELECT source, source_size,
        least(CAST(cap AS DOUBLE), max(CASE WHEN level * weight <= cap THEN level END) OVER () * weight) AS target,
        CAST(sum(source_size) OVER () AS BIGINT) AS corpus_size,
        CAST(round(sum(source_size) OVER () / {BLOCK_WORDS}) AS BIGINT) AS corpus_blocks
      FROM levels),
    seated AS ({seats("targets", "", "source", "target", "corpus_size", "corpus_blocks", "source_blocks")}),
    placed AS (
      SELECT *, sum(size) OVER (PARTITION BY source, shard) AS shard_size,
        coalesce(sum(size) OVER (PARTITION BY source, shard ORDER BY draw, doc_id, size
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
      FROM (
        SELECT d.*, s.source_size, s.target, s.source_blocks,
          draw % greatest(1, CAST(ceil(source_size / {WORDS_PER_SHARD}) AS BIGINT)) AS shard
        FROM (SELECT *, {digits("doc_id")} AS draw FROM sized) d
        JOIN seated s ON d.source IS NOT DISTINCT FROM s.source)),
    shards AS (
      SELECT DISTINCT source, shard, source_size, source_blocks, CAST(shard_size AS BIGINT) AS shard_size FROM placed),
    given AS ({seats("shards", "source", "shard", "shard_size", "source_size", "source_blocks", "quota")}),
    cut AS (
      SELECT source, shard, blocks, least(quota, {MOST_REPEATS} * blocks) // blocks AS whole_times,
        least(quota, {MOST_REPEATS} * blocks) % blocks AS chosen,
        shard_size // blocks AS word_count, shard_size % blocks AS longer,
        {digits("source", "shard")} % blocks AS shift
      FROM (SELECT *, greatest(1, CAST(round(shard_size / {BLOCK_WORDS}) AS BIGINT)) AS blocks FROM given))
    SELECT doc_id, size, source_size, target,
      CAST(whole_times * size + {words("(start + size)")} - {words("start")} AS BIGINT) AS taken
    FROM placed p JOIN cut c ON p.source IS NOT DISTINCT FROM c.source AND p.shard = c.shard"""
