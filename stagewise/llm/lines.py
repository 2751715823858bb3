"""Line dedup by content-defined chunks of lines.

Every line has a hash; a rolling hash over the last ``window`` line hashes ends a chunk where it
falls into the lowest ``1/spread`` of its range. Boundaries depend on nearby lines only, so they
come back after lines were put in or taken out. A chunk of two or more filled lines that also stands
at an earlier place of the corpus (smaller id, then earlier in the text) is removed, once its bytes
were compared with those of the place that stays.

Whether a passage holds a whole chunk is up to its boundaries, so passages of a few lines are often
missed. :func:`dedup_line_runs` has no boundaries to miss: every two filled lines that follow each other
are a chunk, and so is every single line of over ``LONG_WORDS`` words. What two places share in lines, from
two filled ones or one long one on, is the union of such chunks and goes at the later place.

Columns only: no Python code runs on rows. Chunks are matched on narrow rows (digest, row, number);
the texts are dealt once to fetch the chunks that look repeated and once to be rewritten.

Defined cases: a null text stays null, an empty one empty; a text all of whose chunks are repeats
becomes empty, its row stays; rows that are equal in id and text count as one place, so all stay whole;
a null id sorts first; further columns are kept as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stagewise.llm.shared import free_names, read_table, written

#: Modulus, multiplier and share of the rolling hash; line hashes have 28 bits.
MODULUS = 268435399
FACTOR = 31
WINDOW = 2
SPREAD = 3
#: A single line of more words than this is a chunk of its own.
LONG_WORDS = 50
WORD = r"[^\x20\x09-\x0D]+"


def _ends(lines: Column, window: int, spread: int) -> Column:
    """Numbers (from 1) of the lines that end a chunk."""

    def cut(values: Column) -> Column:
        def rolled(i: Column) -> Column:
            total = F.lit(0).cast("long")
            for back in range(window):
                there = F.coalesce(F.get(values, i - 1 - back), F.lit(0).cast("long"))
                total = F.pmod(total + there * F.lit(FACTOR**back % MODULUS), F.lit(MODULUS))
            return total

        return F.filter(
            F.sequence(F.lit(1), F.size(values)),
            lambda i: (i == F.size(values)) | (rolled(i) < MODULUS // spread),
        )

    def line_hash(x: Column) -> Column:
        return F.conv(F.substring(F.md5(x.cast("binary")), 1, 7), 16, 10).cast("long")

    # The array of hashes is bound once by a one-row transform instead of being spelled out
    # for every line.
    return F.get(F.transform(F.array(F.transform(lines, line_hash)), cut), 0)


def _spans(lines: Column, window: int, spread: int) -> Column:
    """First and last line of every chunk."""

    def spans(ends: Column) -> Column:
        return F.transform(
            ends,
            lambda e, k: F.struct((F.coalesce(F.get(ends, k - 1), F.lit(0)) + 1).alias("a"), e.alias("z")),
        )

    return F.get(F.transform(F.array(_ends(lines, window, spread)), spans), 0)


def _overlapping(lines: Column, long_words: int) -> Column:
    """First line, last line and digest of every two filled lines that follow each other and of every long line."""

    def line(i: Column) -> Column:
        return F.get(lines, i - 1)

    def digest(a: Column, z: Column) -> Column:
        return F.unhex(F.md5(F.array_join(F.slice(lines, a, z - a + 1), "\n").cast("binary")))

    def spans(filled: Column) -> Column:
        pairs = F.transform(
            F.filter(
                F.transform(filled, lambda a, k: F.struct(a.alias("a"), F.get(filled, k + 1).alias("z"))),
                lambda s: s["z"].isNotNull(),
            ),
            lambda s: F.struct(s["a"].alias("a"), s["z"].alias("z"), digest(s["a"], s["z"]).alias("digest")),
        )
        # So many words have as many separators between them.
        long = F.filter(
            filled,
            lambda i: (F.length(line(i)) > 2 * long_words) & (F.regexp_count(line(i), F.lit(WORD)) > long_words),
        )
        return F.concat(pairs, F.transform(long, lambda i: F.struct(i.alias("a"), i.alias("z"), digest(i, i).alias("digest"))))

    numbers = F.filter(F.sequence(F.lit(1), F.size(lines)), lambda i: F.trim(line(i)) != "")
    return F.get(F.transform(F.array(numbers), spans), 0)


def dedup_line_runs(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", long_words: int = LONG_WORDS
) -> DataFrame:
    """All columns of ``docs``, the text without the lines that repeat an earlier place (two filled lines or more that
    follow each other, or one of over ``long_words`` words), and ``n_lines``, ``removed_runs``, ``removed_lines``.

    The first place of a line always stays, so no line is lost; where a run meets itself (one line many times
    over) its first lines stay."""
    rid, mark, gone_, *made = free_names(docs, "row_id", "row_mark", "gone", "n_lines", "removed_runs", "removed_lines")
    keyed = docs.withColumn(rid, F.coalesce(F.col(doc_id).cast("string"), F.lit("")))
    keyed = keyed.withColumn(mark, F.unhex(F.md5(F.col(text).cast("binary"))))
    keys = [rid, mark]
    lines = F.split(F.col(text), "\n", -1)
    places = written(
        keyed.where(F.col(text).isNotNull())
        .select(F.col(doc_id).alias("id"), *keys, lines.alias("lines"))
        .select("id", *keys, F.posexplode(_overlapping(F.col("lines"), long_words)).alias("k", "span"))
        .select("id", *keys, "k", "span.*")
    )
    place = F.struct("id", *keys, "k")
    repeated = (
        places.groupBy("digest")
        .agg(F.min(place).alias("stays"), F.max(place).alias("last"))
        .where(F.col("stays") != F.col("last"))
    )
    seen = written(
        places.join(repeated.select("digest", "stays"), "digest")
        .withColumn("is_first", place == F.col("stays"))
        .select(*keys, "k", "a", "z", "digest", "is_first")
    )
    # The bytes of the chunks in question, from one deal of the texts.
    asked = seen.distinct().groupBy(*keys).agg(F.collect_list(F.struct("k", "a", "z", "digest", "is_first")).alias("asked"))

    def with_bytes(c: Column) -> Column:
        body = F.array_join(F.slice(F.col("lines"), c["a"], c["z"] - c["a"] + 1), "\n")
        return F.struct(c["k"].alias("k"), c["a"].alias("a"), c["z"].alias("z"), c["digest"].alias("digest"), c["is_first"].alias("is_first"), body.alias("bytes"))

    fetched = written(
        keyed.select(*keys, F.col(text))
        .join(asked, keys)
        .dropDuplicates(keys)  # equal rows are one place
        .select(*keys, lines.alias("lines"), "asked")
        .select(*keys, F.explode(F.transform("asked", with_bytes)).alias("c"))
        .select(*keys, "c.*")
    )
    kept = fetched.where("is_first").select("digest", F.col("bytes").alias("first_bytes"))
    spans = (
        fetched.where("NOT is_first").join(kept, "digest")
        .where(F.col("bytes") == F.col("first_bytes"))
        .select(*keys, "a", "z")
    )
    # Chunks that overlap become one run.
    order = Window.partitionBy(*keys).orderBy("a", "z")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    new = F.coalesce((F.col("a") > F.max("z").over(before)).cast("int"), F.lit(1))
    gone = (
        spans.withColumn("new", new)
        .withColumn("run", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        .groupBy(*keys, "run")
        .agg(F.min("a").alias("a"), F.max("z").alias("z"))
        .groupBy(*keys)
        .agg(F.collect_list(F.struct("a", "z")).alias(gone_))
    )
    cut, has = F.col(gone_), F.col(gone_).isNotNull()
    left = F.filter(lines, lambda x, i: ~F.exists(cut, lambda g: (i + 1 >= g["a"]) & (i + 1 <= g["z"])))
    removed = F.aggregate(cut, F.lit(0).cast("long"), lambda s, g: s + g["z"] - g["a"] + 1)
    rewritten = F.when(has, F.array_join(left, "\n")).otherwise(F.col(text)).alias(text)
    return keyed.join(gone, keys, "left").select(
        *[rewritten if c == text else F.col(c) for c in docs.columns],
        F.coalesce(F.size(lines).cast("long"), F.lit(0)).alias(made[0]),
        F.when(has, F.size(cut)).otherwise(0).cast("long").alias(made[1]),
        F.when(has, removed).otherwise(0).cast("long").alias(made[2]),
    )


def dedup_line_chunks(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    window: int = WINDOW,
    spread: int = SPREAD,
    min_lines: int = 2,
) -> DataFrame:
    """All columns of ``docs``, the text without repeated chunks, and ``n_lines``, ``removed_chunks``,
    ``removed_lines``."""
    rid, mark, gone_, *made = free_names(
        docs, "row_id", "row_mark", "gone", "n_lines", "removed_chunks", "removed_lines"
    )
    keyed = docs.withColumn(rid, F.coalesce(F.col(doc_id).cast("string"), F.lit("")))
    keyed = keyed.withColumn(mark, F.md5(F.col(text).cast("binary")))
    keys = [rid, mark]

    def joined(a: Column, z: Column) -> Column:
        return F.array_join(F.slice(F.col("lines"), a, z - a + 1), "\n")

    narrow = keyed.where(F.contains(F.col(text), F.lit("\n"))).select(
        F.col(doc_id).alias("id"), *keys, F.split(F.col(text), "\n", -1).alias("lines")
    )
    chunks = narrow.select(
        "id", *keys, "lines", F.posexplode(_spans(F.col("lines"), window, spread)).alias("k", "span")
    ).where(F.col("span.z") - F.col("span.a") + 1 >= min_lines)
    filled = F.size(
        F.filter(
            F.slice(F.col("lines"), F.col("span.a"), F.col("span.z") - F.col("span.a") + 1),
            lambda x: F.trim(x) != "",  # not only spaces
        )
    )
    chunks = chunks.where(filled >= min_lines)
    places = written(
        chunks.select(
            "id",
            *keys,
            "k",
            F.col("span.a").alias("a"),
            F.col("span.z").alias("z"),
            F.md5(joined(F.col("span.a"), F.col("span.z")).cast("binary")).alias("digest"),
        )
    )
    place = F.struct("id", *keys, "k")
    repeated = (
        places.groupBy("digest")
        .agg(F.min(place).alias("stays"), F.max(place).alias("last"))
        .where(F.col("stays") != F.col("last"))
    )
    seen = written(
        places.join(repeated.select("digest", "stays"), "digest")
        .withColumn("is_first", place == F.col("stays"))
        .select(*keys, "k", "a", "z", "digest", "is_first")
    )
    # The bytes of the chunks in question, from one deal of the texts.
    asked = seen.distinct().groupBy(*keys).agg(F.collect_list(F.struct("k", "a", "z", "digest", "is_first")).alias("asked"))
    lines = F.split(F.col(text), "\n", -1)
    fetched = (
        keyed.select(*keys, F.col(text))
        .join(asked, keys)
        .select(*keys, lines.alias("lines"), F.explode("asked").alias("c"))
        .select(*keys, "c.*", joined(F.col("c.a"), F.col("c.z")).alias("bytes"))
        .dropDuplicates([*keys, "k"])  # equal rows are one place
    )
    fetched = written(fetched)
    kept = fetched.where("is_first").select("digest", F.col("bytes").alias("first_bytes"))
    gone = (
        fetched.where("NOT is_first").join(kept, "digest")
        .where(F.col("bytes") == F.col("first_bytes"))
        .groupBy(*keys)
        .agg(F.collect_list(F.struct("a", "z")).alias(gone_))
    )
    cut, has = F.col(gone_), F.col(gone_).isNotNull()
    all_lines = F.split(F.col(text), "\n", -1)
    left = F.filter(all_lines, lambda x, i: ~F.exists(cut, lambda g: (i + 1 >= g["a"]) & (i + 1 <= g["z"])))
    removed = F.aggregate(cut, F.lit(0).cast("long"), lambda s, g: s + g["z"] - g["a"] + 1)
    rewritten = F.when(has, F.array_join(left, "\n")).otherwise(F.col(text)).alias(text)
    return keyed.join(gone, keys, "left").select(
        *[rewritten if c == text else F.col(c) for c in docs.columns],
        F.coalesce(F.size(all_lines).cast("long"), F.lit(0)).alias(made[0]),
        F.when(has, F.size(cut)).otherwise(0).cast("long").alias(made[1]),
        F.when(has, removed).otherwise(0).cast("long").alias(made[2]),
    )


def op9_lines(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_line_chunks(docs)


def lines_sql(documents: str = "documents") -> str:
    """The result of :func:`op9_lines` with one row per line."""
    return f"""
WITH line AS (
  SELECT doc_id, md5(text) AS mark, text, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS i
  FROM {documents}
), hashed AS (
  SELECT *, ('0x' || substr(md5(line), 1, 7))::BIGINT AS v,
         len(string_split(text, chr(10))) AS n FROM line
), ended AS (
  SELECT *, (v + lag(v, 1, 0::BIGINT) OVER (PARTITION BY doc_id ORDER BY i) * {FACTOR}) % {MODULUS}
         < {MODULUS // SPREAD} OR i = n AS is_end FROM hashed
), numbered AS (
  SELECT *, sum(is_end::INT) OVER (PARTITION BY doc_id ORDER BY i) - is_end::INT AS k FROM ended
), chunk AS (
  SELECT doc_id, mark, k, string_agg(line, chr(10) ORDER BY i) AS bytes, count(*) AS lines
  FROM numbered GROUP BY doc_id, mark, k
  HAVING count(*) FILTER (WHERE replace(line, ' ', '') <> '') >= 2
), repeat AS (
  SELECT *, row_number() OVER (PARTITION BY bytes ORDER BY doc_id, mark, k) > 1 AS gone FROM chunk
), rest AS (
  SELECT doc_id, string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT coalesce(gone, false)) AS text,
         count(*) AS n_lines, count(*) FILTER (WHERE gone) AS removed_lines,
         count(DISTINCT k) FILTER (WHERE gone) AS removed_chunks
  FROM numbered LEFT JOIN repeat USING (doc_id, mark, k) GROUP BY doc_id
)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(rest.text, '') END AS text,
       coalesce(n_lines, 0) AS n_lines, coalesce(removed_chunks, 0) AS removed_chunks,
       coalesce(removed_lines, 0) AS removed_lines
FROM {documents} d LEFT JOIN rest ON d.doc_id = rest.doc_id"""
