"""Secret scans judged by corpus-wide ownership.

Base kinds are fixed patterns. Wider candidates (long runs of token characters with letters and
digits) say nothing by themselves; what tells an example from a credential is who holds it. All
candidate values are hashed, and for every hash the corpus is asked how many distinct repositories
and owners hold it. A value of at least ``example_owners`` owners is a widely copied example; one of fewer is
live-looking. Live-looking wide candidates that no base span touches are added as kind ``owned``; base
spans stay, whatever the verdict, which is reported beside them.

Columns only: no Python code runs on rows. One pass over the texts finds the spans; only hashes,
places and owners are dealt, first combined on the map side, so a value in a third of all rows is a
few rows per task.

Defined cases: a null text is empty and has no spans (empty string); a null owner or repository is an
owner of its own; equal rows each get their result; places are code points, ends exclusive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stagewise.llm.shared import read_table, written

# The patterns of the contract, in Java's and RE2's common syntax.
_WORDS = "password|passwd|secret|token|api_?key"
ASSIGN_VALUE = "[A-Za-z0-9+/_.=-]+"
ASSIGN = (
    "(?:"
    + "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in _WORDS)
    + r")[\"']?\x20*[:=]\x20*[\"']?"
    + ASSIGN_VALUE
)
ASSIGN_HEAD = r"^[^:=]*[:=]\x20*[\"']?"
ACCESS = "AKIA[A-Z0-9]+"
HEX = "[0-9a-f]+"
LEAST = {"assign": 6, "access": 20, "hex": 24}
KINDS = ("assign", "access", "hex", "owned")

#: Wide candidates, and from how many owners on a value is a copied example.
WIDE = "[A-Za-z0-9+/_=-]{20,}"
EXAMPLE_OWNERS = 3

#: Matches of a text whose places are summed at once.
PIECE = 128


def _before(steps: Column) -> Column:
    """Sums of all numbers before each one, from sums of whole pieces and of what stands before it in its piece, so
    that a text of very many matches costs a bounded number of additions each. ``steps`` is a name, not a term: it is read often."""
    pieces = F.sequence(F.lit(0), F.floor((F.size(steps) - 1) / PIECE).cast("int"))

    def total(numbers: Column) -> Column:
        return F.aggregate(numbers, F.lit(0), lambda s, x: s + x)

    def summed(sums: Column) -> Column:
        return F.transform(sums, lambda _, p: total(F.slice(sums, 1, p)))

    def spread(heads: Column) -> Column:
        def within(p: Column, head: Column) -> Column:
            piece = F.slice(steps, p * PIECE + 1, F.lit(PIECE))
            return F.get(
                F.transform(F.array(piece), lambda x: F.transform(x, lambda _, i: head + total(F.slice(x, 1, i)))), 0
            )

        return F.flatten(F.zip_with(pieces, heads, within))

    sums = F.transform(pieces, lambda p: total(F.slice(steps, p * PIECE + 1, F.lit(PIECE))))
    heads = F.get(F.transform(F.array(sums), summed), 0)
    return F.get(F.transform(F.array(heads), spread), 0)


def _found(text: Column, pattern: str, kind: int, value) -> Column:
    """Array of (a, kind, z, value) of all matches: places come from the lengths of what stands
    between the matches, so texts without one are never split."""
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    empty = F.array().cast("array<struct<a:int,kind:int,z:int,value:string>>")

    def placed(m: Column) -> Column:
        def spans(gaps: Column) -> Column:
            # The last gap stands behind the last match.
            steps = F.zip_with(m, F.slice(gaps, 1, F.size(m)), lambda x, g: F.length(g) + F.length(x))

            def span(x: Column, to: Column) -> Column:
                return F.struct(
                    (to - F.length(x)).alias("a"), F.lit(kind).alias("kind"), to.alias("z"), value(x).alias("value")
                )

            ends = F.transform(F.array(steps), lambda x: F.zip_with(x, _before(x), lambda step, before: before + step))
            return F.zip_with(m, F.get(ends, 0), span)

        return F.when(F.size(m) == 0, empty).otherwise(
            F.get(F.transform(F.array(F.split(text, pattern, -1)), spans), 0)
        )

    return F.get(F.transform(F.array(matches), placed), 0)


def _hexed(value: Column) -> Column:
    return F.md5(value.cast("binary"))


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(
            F.array_sort(spans),
            lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["a"].cast("string"), s["z"].cast("string")),
        ),
        ",",
    )


def scan_secrets(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    owner: str = "source",
    repository: str | None = None,
    example_owners: int = EXAMPLE_OWNERS,
) -> DataFrame:
    """One row per document: its spans (a, kind number, z, value hash, owners, repositories,
    is_live) in ``base``, and in ``added`` those that the corpus adds. ``repository``: SQL for the repository of a row; an owner has many."""
    body = F.coalesce(F.col(text), F.lit(""))
    assign = F.filter(
        _found(body, ASSIGN, 0, lambda x: F.regexp_replace(x, ASSIGN_HEAD, "")),
        lambda s: F.length(s["value"]) >= LEAST["assign"],
    )
    access = F.filter(_found(body, ACCESS, 1, lambda x: x), lambda s: s["z"] - s["a"] >= LEAST["access"])
    # A run of one class is found whole or not at all, so the least length can be in the pattern.
    hexes = _found(body, "[0-9a-f]{%d,}" % LEAST["hex"], 2, lambda x: x)
    wide = F.filter(
        _found(body, WIDE, 3, lambda x: x),
        lambda s: s["value"].rlike("[0-9]") & s["value"].rlike("[A-Za-z]"),
    )
    spans = F.concat(assign, access, hexes, wide)
    hashed = F.transform(
        spans,
        lambda s: F.struct(s["a"].alias("a"), s["kind"].alias("kind"), s["z"].alias("z"), _hexed(s["value"]).alias("hash")),
    )
    own = F.coalesce(F.concat(F.lit("o"), F.col(owner)), F.lit(""))
    repo = F.coalesce(F.expr(repository).cast("string"), F.lit("")) if repository else own
    scanned = written(
        docs.select(
            F.col(doc_id).alias("doc_id"),
            F.xxhash64(F.col(text)).alias("text_mark"),
            own.alias("owner"),
            repo.alias("repository"),
            hashed.alias("spans"),
        )
    )
    held = scanned.where(F.size("spans") > 0).select(
        "doc_id", "text_mark", "owner", "repository", F.explode("spans").alias("s")
    )
    pairs = held.groupBy("s.hash", "owner", "repository").agg(F.count("*").alias("places"))
    by_owner = pairs.groupBy("hash", "owner").agg(F.count("*").alias("repositories"))
    ownership = by_owner.groupBy("hash").agg(
        F.count("*").alias("owners"), F.sum("repositories").alias("repositories")
    )
    judged = held.select("doc_id", "text_mark", "s").distinct().join(ownership, F.col("s.hash") == ownership["hash"])
    judged = judged.select(F.col("doc_id").alias("judged_id"), F.col("text_mark").alias("judged_mark"), "s", "owners", "repositories")
    # A base span touches another span if it begins no later and ends behind its begin, or begins inside it.
    whole = Window.partitionBy("judged_id", "judged_mark")
    is_base = F.col("s.kind") < 3
    reached = F.max(F.when(is_base, F.col("s.z"))).over(whole.orderBy(F.col("s.a")))
    follows = F.min(F.when(is_base, F.col("s.a"))).over(whole.orderBy(F.col("s.a").desc()))
    touched = F.coalesce(reached > F.col("s.a"), F.lit(False)) | F.coalesce(follows < F.col("s.z"), F.lit(False))
    is_live = F.col("owners") < example_owners
    place = F.struct(
        F.col("s.a").alias("a"), F.col("s.kind").alias("kind"), F.col("s.z").alias("z"),
        F.col("s.hash").alias("hash"), "owners", "repositories", is_live.alias("is_live"),
    )
    judged = (
        judged.withColumns({"is_base": is_base, "is_added": ~is_base & is_live & ~touched, "place": place})
        .groupBy("judged_id", "judged_mark")
        .agg(
            F.collect_list(F.when(F.col("is_base"), F.col("place"))).alias("base"),
            F.collect_list(F.when(F.col("is_added"), F.col("place"))).alias("added"),
        )
    )
    same = F.col("doc_id").eqNullSafe(F.col("judged_id")) & (F.col("text_mark") == F.col("judged_mark"))
    return scanned.join(judged, same, "left").select("doc_id", "base", "added")


def op4_secrets(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    found = scan_secrets(docs, repository="concat_ws('/', source, lang)")
    base = F.coalesce("base", F.array().cast(found.schema["base"].dataType))
    spans = F.coalesce(F.concat("base", "added"), base)

    def number(kind: int) -> Column:
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{KINDS[kind]}")

    return found.select(
        "doc_id",
        *[number(k) for k in range(3)],
        F.sha2(_joined(base).cast("binary"), 256).alias("base_sha256"),
        _joined(spans).alias("spans"),
        F.size(F.filter(spans, lambda s: s["is_live"])).cast("long").alias("n_live"),
        F.size(F.filter(spans, lambda s: ~s["is_live"])).cast("long").alias("n_example"),
    )


def secrets_sql(documents: str = "documents") -> str:
    """The result of :func:`op4_secrets` with one row per match."""

    def matches(kind: int, pattern: str, value: str, keep: str) -> str:
        pattern = pattern.replace("'", "''")
        return f"""
  SELECT * FROM (
    SELECT doc_id, owner, repository, {kind} AS kind, m,
           {value} AS value,
           list_sum([len(g) for g in gaps[1:i]]) + coalesce(list_sum([len(g) for g in hits[1:i - 1]]), 0) AS a
    FROM (
      SELECT *, unnest(hits) AS m, generate_subscripts(hits, 1) AS i FROM (
        SELECT doc_id, owner, repository, regexp_extract_all(text, '{pattern}') AS hits,
               regexp_split_to_array(text, '{pattern}') AS gaps FROM held)))
  WHERE {keep}"""

    head = ASSIGN_HEAD.replace("'", "''")
    parts = [
        matches(0, ASSIGN, f"regexp_replace(m, '{head}', '')", "len(value) >= 6"),
        matches(1, ACCESS, "m", "len(m) >= 20"),
        matches(2, HEX, "m", "len(m) >= 24"),
        matches(3, WIDE, "m", "regexp_matches(m, '[0-9]') AND regexp_matches(m, '[A-Za-z]')"),
    ]
    return f"""
WITH held AS (
  SELECT doc_id, coalesce(text, '') AS text, coalesce('o' || source, '') AS owner,
         concat_ws('/', source, lang) AS repository FROM {documents}
), hit AS ({" UNION ALL ".join(parts)}
), span AS (SELECT *, (a + len(m))::BIGINT AS z FROM hit
), ownership AS (
  SELECT value, count(DISTINCT owner) < {EXAMPLE_OWNERS} AS is_live FROM span GROUP BY value
), judged AS (
  SELECT span.*, is_live, ['assign', 'access', 'hex', 'owned'][kind + 1] AS name FROM span JOIN ownership USING (value)
), kept AS (
  SELECT * FROM judged s WHERE kind < 3 OR (is_live AND NOT EXISTS (
    SELECT 1 FROM judged b WHERE b.doc_id = s.doc_id AND b.kind < 3 AND b.a < s.z AND s.a < b.z))
), result AS (
  SELECT doc_id, count(*) FILTER (WHERE kind = 0) AS n_assign, count(*) FILTER (WHERE kind = 1) AS n_access,
         count(*) FILTER (WHERE kind = 2) AS n_hex,
         string_agg(name || ':' || a || ':' || z, ',' ORDER BY a, kind) FILTER (WHERE kind < 3) AS base,
         string_agg(name || ':' || a || ':' || z, ',' ORDER BY a, kind) AS spans,
         count(*) FILTER (WHERE is_live) AS n_live, count(*) FILTER (WHERE NOT is_live) AS n_example
  FROM kept GROUP BY doc_id
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
       coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans,
       coalesce(n_live, 0) AS n_live, coalesce(n_example, 0) AS n_example
FROM held LEFT JOIN result USING (doc_id)"""
