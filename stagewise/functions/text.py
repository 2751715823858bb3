"""Message and text columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stagewise.functions.columns import col
from stagewise.sources.scans import EVENT_TYPES

# Mention marks, message keywords and prefixes, in the order they are tested.
MENTION = r"@_user_\d+\s*"
KEYWORD_INTENTS = {
    "reset": ("重置", "重新开始", "清空", "新查询", "重新查询", "reset"),
    "help": ("帮助", "help", "用法", "使用说明"),
    "fast_mode_on": (
        "快速模式", "不需要确认", "不用确认", "不需要sql", "不用sql", "跳过sql", "直接出数模式", "快速出数",
    ),
    "fast_mode_off": ("审查模式", "需要确认", "看sql", "要确认sql", "恢复确认"),
    "confirm": ("确认", "执行", "跑", "ok", "OK", "可以", "没问题", "对", "yes", "Yes", "好"),
    "cancel": ("取消", "算了", "不用了", "放弃"),
}
PREFIX_INTENTS = {
    "modify": ("修改", "改一下", "帮我改", "修改意见", "修改建议", "调整", "需要改"),
    "fast_query": ("直接跑", "直接执行", "直接出数", "跳过确认"),
}
PREFIX_SEPARATORS = "：: "
UNREADABLE = {"understanding": "AI 返回格式异常，请重试", "sql": ""}
# Where an answer may stand in a text: in the first fenced block, between the outermost braces.
FENCED = r"(?s)```(?:json)?\s*\n?(.*?)\n?```"
BRACED = r"(?s)\{.*\}"

NO_NUMBER = '^"(NaN|-?Infinity)"$'

# What valid JSON can look like from outside; parsing anything else only raises errors.
_JSON_SHAPE = r'(?s)^(?:\{.*\}|\[.*\]|".*"|-?[0-9][0-9.eE+-]*|true|false|null|NaN|-?Infinity)$'

ANSWER_SCHEMA = T.StructType(
    [
        T.StructField("understanding", T.StringType()),
        T.StructField("sql", T.StringType()),
        T.StructField("output_fields", T.ArrayType(T.StringType())),
        T.StructField("estimated_rows", T.StringType()),
        T.StructField("filename", T.StringType()),
    ]
)


def strip(c: str | Column) -> Column:
    """White space of any kind removed at both ends."""
    return F.regexp_replace(col(c), r"(?U)^\s+|\s+$", "")


def clean_messages(df: DataFrame, text: str, message_type: str | None = None) -> DataFrame:
    """Text messages without mention marks and outer white space; blank ones are dropped.
    ``message_type`` names a column that must say ``text``, if there is one."""
    if message_type is not None:
        df = df.where(F.col(message_type) == "text")
    cleaned = df.withColumn(text, strip(F.regexp_replace(F.col(text), "(?U)" + MENTION, "")))
    return cleaned.where(F.col(text) != "")


def intent_of(text: str | Column) -> Column:
    """Intent of one message by whole-text keyword, then by prefix; else ``query``."""
    text = strip(text)
    intent = F
    for name, keywords in KEYWORD_INTENTS.items():
        intent = intent.when(text.isin(*keywords), name)
    for name, prefixes in PREFIX_INTENTS.items():
        starts = text.startswith(prefixes[0])
        for prefix in prefixes[1:]:
            starts = starts | text.startswith(prefix)
        intent = intent.when(starts, name)
    return intent.otherwise("query")


def fast_requirement(text: str | Column) -> Column:
    """What a ``fast_query`` message asks for, NULL for other messages."""
    text = strip(text)
    prefixes = "|".join(PREFIX_INTENTS["fast_query"])
    asked = strip(F.regexp_replace(text, f"^(?:{prefixes})[{PREFIX_SEPARATORS}]*", ""))
    return F.when(intent_of(text) == "fast_query", asked)


def tag_intent(df: DataFrame, text: str) -> DataFrame:
    return df.withColumns({"intent": intent_of(text), "requirement": fast_requirement(text)})


_STRICT = {"allowSingleQuotes": "false"}


def _is_json(text: Column) -> Column:
    """One whole JSON value, nothing before or after it. Readers stop after the first value, so it is read once, as the
    only item of a list under one name, with a second name behind it that no text can hold: text that goes on shows as a
    further item or name, or hides the second one. NaN and infinities count as values, and a key may come twice."""
    last = F.md5(text.cast("binary"))
    wrapped = F.concat(F.lit('{"v":['), text, F.lit('],"'), last, F.lit('":[]}'))

    def whole(read: Column) -> Column:
        return (F.size(read) == 2) & (F.size(F.element_at(read, "v")) == 1) & F.element_at(read, last).isNotNull()

    return text.rlike(_JSON_SHAPE) & F.exists(F.array(F.from_json(wrapped, "map<string,array<string>>", _STRICT)), whole)


def parse_tolerant(c: str | Column, schema: T.StructType = ANSWER_SCHEMA, default: dict = UNREADABLE) -> Column:
    """JSON record from free text: the whole text, else the first fenced block, else
    everything between the outermost braces; ``default`` when none of them is one JSON value. Of a
    key that comes twice the last value counts. Values are given as text (``NaN`` as such); single
    quotes, comments and escapes that JSON does not know are no JSON here either. A candidate is read only if those before
    it are none: an answer that is JSON as it stands is read twice, once to see that and once for its fields.
    Give it a column of its own and take fields from there, so that it is parsed once."""

    def first(candidate: Column, unlike: Column | None = None) -> Column:
        def fits(t: Column) -> Column:
            return _is_json(t) if unlike is None else (t != unlike) & _is_json(t)

        return F.get(F.filter(F.array(candidate), fits), F.lit(0))

    def found(whole: Column) -> Column:
        fenced = strip(F.regexp_extract(whole, FENCED, 1))
        return F.coalesce(first(whole), first(fenced), first(F.regexp_extract(whole, BRACED, 0), unlike=whole))

    # A one-element array names the stripped text, so that it is computed once.
    text = F.get(F.transform(F.array(strip(c)), found), F.lit(0))
    fallback = F.to_json(F.struct(*[F.lit(v).alias(k) for k, v in default.items()]))
    record = F.from_json(F.coalesce(text, fallback), schema, _STRICT)
    # The reader puts quotes around what is no number when it is asked for text.
    texts = [f.name for f in schema if isinstance(f.dataType, T.StringType)]

    def plain(r: Column) -> Column:
        bare = [F.regexp_replace(r[f.name], NO_NUMBER, "$1") if f.name in texts else r[f.name] for f in schema]
        return F.when(r.isNotNull(), F.struct(*[c.alias(f.name) for c, f in zip(bare, schema, strict=True)]))

    return F.get(F.transform(F.array(record), plain), F.lit(0))


def event_type_of(event_key: str | Column) -> Column:
    """Type of an event: the prefix of its key, ``other`` for unknown prefixes."""
    prefix = F.split_part(col(event_key), F.lit("_"), F.lit(1))
    return F.when(prefix.isin(*EVENT_TYPES), prefix).otherwise("other")
