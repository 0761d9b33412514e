"""Chat formatting with typed content parts, in DataFrame expressions only.

A turn's content is a list of typed parts: text, image, audio or document.  A
visitor flattens them in order: text is escaped, every other part becomes a
placeholder, with its reference and its expanded token count recorded.  A
turn is rendered as

    <s>role[INST]content[/INST]</s>

Control strings inside texts and roles are broken up by a backslash after
their first character, and backslashes are doubled; dropping one backslash
from each escape restores the text exactly.  An unescaped control string can
therefore only come from the template, and the output can be cut into its
turns again.

``format_turns`` gives one row per turn and never gathers a conversation;
``format_conversations`` joins a conversation's turns into one string, which
has to fit a row.

Edge cases: null text, role or part values are empty; an unknown part kind is
a document; turns are ordered by turn, then role and content, so ties have a
fixed order and repeated rows stay; a null conv_id is a conversation of its
own; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the template.
TURN_OPEN, CONTENT, CONTENT_END, TURN_END = "<s>", "[INST]", "[/INST]", "</s>"
PLACEHOLDERS = {"image": "[IMAGE]", "audio": "[AUDIO]", "document": "[DOCUMENT]"}
CONTROL = r"(<(?=/?s>)|\[(?=/?(?:INST|IMAGE|AUDIO|DOCUMENT)\]))"

IMAGE_PATCH = 14          # pixels of a patch's side; one token a patch
AUDIO_RATE = 25           # tokens a second
DOCUMENT_PAGE = 512       # tokens a page
TRAINED_ROLES = ("assistant",)

PART = ("struct<kind:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>")


def escape(text: Column) -> Column:
    doubled = F.replace(F.coalesce(text, F.lit("")), F.lit("\\"), F.lit("\\\\"))
    return F.regexp_replace(doubled, CONTROL, r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def text_parts(text: Column) -> Column:
    """The content of a plain text: one text part."""
    none = {f: F.lit(None) for f in ("ref", "width", "height", "seconds", "pages")}
    return F.array(F.struct(F.lit("text").alias("kind"), text.alias("text"),
                            *[v.alias(n) for n, v in none.items()]).cast(PART))


def _kind(part: Column) -> Column:
    kind = F.lower(F.coalesce(part["kind"], F.lit("text")))
    return F.when(kind.isin("text", "image", "audio"), kind).otherwise("document")


def _visit(part: Column) -> Column:
    """A part's place in the content: escaped text or a placeholder."""
    kind = _kind(part)
    out = F.when(kind == "text", escape(part["text"]))
    for name, mark in PLACEHOLDERS.items():
        out = out.when(kind == name, F.lit(mark))
    return out


def _expanded(part: Column) -> Column:
    """Tokens that a placeholder stands for."""
    side = lambda v: F.ceil(F.coalesce(v, F.lit(0)) / IMAGE_PATCH)
    kind = _kind(part)
    return F.when(kind == "image", side(part["width"]) * side(part["height"])) \
        .when(kind == "audio", F.ceil(F.coalesce(part["seconds"], F.lit(0.0)) * AUDIO_RATE)) \
        .otherwise(F.coalesce(part["pages"], F.lit(0)) * DOCUMENT_PAGE).cast("bigint")


def format_turns(turns: DataFrame, parts: str = "parts") -> DataFrame:
    """``turns`` (conv_id, turn, role, ``parts``) with one row a turn: the
    rendered ``chunk``, where its content begins and how long it is
    (``content_at, content_chars``, code points), whether it is trained on
    (``in_loss``), and its ``attachments`` (kind, ref, tokens) in order."""
    role = F.coalesce(F.col("role"), F.lit(""))
    own = F.coalesce(F.col(parts), F.array().cast(f"array<{PART}>"))
    own = F.transform(own, lambda p: F.coalesce(p, F.struct(*[F.lit(None)] * 7).cast(PART)))
    content = F.concat_ws("", F.transform(own, _visit))
    others = F.filter(own, lambda p: _kind(p) != "text")
    attached = F.transform(others, lambda p: F.struct(
        _kind(p).alias("kind"), p["ref"].alias("ref"), _expanded(p).alias("tokens")))
    head = F.concat(F.lit(TURN_OPEN), escape(role), F.lit(CONTENT))
    return turns.select("conv_id", "turn", head.alias("head"), content.alias("content"),
                        role.isin(*TRAINED_ROLES).alias("in_loss"), attached.alias("attachments")) \
        .select("conv_id", "turn",
                F.concat("head", "content", F.lit(CONTENT_END + TURN_END)).alias("chunk"),
                F.length("head").cast("bigint").alias("content_at"),
                F.length("content").cast("bigint").alias("content_chars"), "in_loss", "attachments")


def format_conversations(turns: DataFrame, parts: str = "parts") -> DataFrame:
    """One row a conversation: ``formatted`` text, ``loss_spans`` (begin, end
    in code points of it), ``attachments`` in order and their ``placeholder_tokens``."""
    rendered = format_turns(turns, parts)
    entry = F.struct("turn", "chunk", "content_at", "content_chars", "in_loss", "attachments")
    whole = rendered.groupBy("conv_id").agg(F.sort_array(F.collect_list(entry)).alias("turns"))
    # running position of each turn: lengths added up once, in order
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<bigint>").alias("begins"))
    walk = F.aggregate("turns", start, lambda acc, t: F.struct(
        (acc["at"] + F.length(t["chunk"])).alias("at"), F.concat(acc["begins"], F.array(acc["at"])).alias("begins")))
    placed = F.zip_with("turns", walk["begins"], lambda t, b: F.struct(
        (b + t["content_at"]).alias("begin"), (b + t["content_at"] + t["content_chars"]).alias("end"),
        t["in_loss"].alias("in_loss")))
    spans = F.transform(F.filter(placed, lambda s: s["in_loss"]), lambda s: F.struct(s["begin"], s["end"]))
    attachments = F.flatten(F.transform("turns", lambda t: t["attachments"]))
    return whole.select(
        "conv_id", F.concat_ws("", F.transform("turns", lambda t: t["chunk"])).alias("formatted"),
        spans.alias("loss_spans"), attachments.alias("attachments"),
        F.aggregate(attachments, F.lit(0).cast("bigint"), lambda n, a: n + a["tokens"]).alias("placeholder_tokens"))


def read_back(formatted: DataFrame) -> DataFrame:
    """(conv_id, turns: array of role and text) cut from the formatted text."""
    chunks = F.split("formatted", TURN_END)
    chunks = F.slice(chunks, 1, F.size(chunks) - 1)
    body = lambda c: F.substring_index(c, CONTENT, -1)
    return formatted.withColumn("turns", F.transform(chunks, lambda c: F.struct(
        unescape(F.substring(F.substring_index(c, CONTENT, 1), len(TURN_OPEN) + 1, 2147483647)).alias("role"),
        unescape(F.substring_index(body(c), CONTENT_END, 1)).alias("text"))))


def digest(formatted: DataFrame) -> DataFrame:
    """The query's columns, read back from the formatted text and its spans."""
    read = read_back(formatted)
    said = F.concat_ws("", F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))))
    masked = F.concat_ws("", F.transform("loss_spans", lambda s: unescape(
        F.substr(F.col("formatted"), (s["begin"] + 1).cast("int"), (s["end"] - s["begin"]).cast("int")))))
    return read.select("conv_id", F.size("turns").cast("bigint").alias("n_turns"),
                       F.sha2(said, 256).alias("turns_sha256"), masked.alias("masked"),
                       F.length("formatted").cast("bigint").alias("formatted_chars")) \
        .select("conv_id", "n_turns", "turns_sha256", F.length("masked").cast("bigint").alias("loss_chars"),
                F.sha2("masked", 256).alias("loss_sha256"), "formatted_chars")


_MARKS = ["<s>", "</s>"] + [f"[{s}{n}]" for n in ("INST", "IMAGE", "AUDIO", "DOCUMENT") for s in ("", "/")]


def _extra_chars(column: str) -> str:
    """SQL for the characters that escaping adds to ``column``."""
    counts = [f"(length({column}) - length(replace({column}, '{m}', ''))) // {len(m)}" for m in ["\\", *_MARKS]]
    return " + ".join(counts)


ORACLE = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), said AS (
  SELECT conv_id, count(*) AS n_turns,
         string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS all_text,
         coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '') AS loss,
         sum(length(role) + length(text) + {_extra_chars('role')} + {_extra_chars('text')}
             + {len(TURN_OPEN + CONTENT + CONTENT_END + TURN_END)}) AS formatted_chars
  FROM turns GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(all_text) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars,
       sha256(loss) AS loss_sha256, CAST(formatted_chars AS BIGINT) AS formatted_chars
FROM said
"""
