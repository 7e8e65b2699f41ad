"""Chat text from turns, proven by reading it back: a grammar round trip with escapes."""

from __future__ import annotations

import re
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.llm.common import field, slices
from riskloom.session import ship_package

# The template, fixed values:  ### Role: text\n</turn>\n
ROLES = {"system": "System", "user": "User", "assistant": "Assistant"}
HEADER = "### {role}: "
FOOTER = "\n</turn>\n"
LEARNED = "assistant"
CLOSE = "</turn>"

# Control strings inside a text, with the backslashes before them.
_CONTROL = re.compile(r"(\\*)(### (?:System|User|Assistant|=[^\s:]*): |</turn>)")
_HEADER = re.compile(r"### (System|User|Assistant|=[^\s:]*): ")
# The first closing mark that no backslash stands before ends a turn.
_FOOTER = re.compile(r"\n(?=</turn>\n)")
_NAMES = {label: role for role, label in ROLES.items()}


def escape(text: str) -> str:
    """One more backslash before each control string."""
    return _CONTROL.sub(r"\\\1\2", text)


def unescape(text: str) -> str:
    """One backslash less before each control string that has one."""
    return _CONTROL.sub(lambda m: m[1][1:] + m[2], text)


def _label(role: str) -> str:
    """Any role as one word without a colon; unknown ones are marked and quoted."""
    return ROLES.get(role) or "=" + quote(role, safe="")


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted text of (role, written text) pairs, and the spans under the loss mask."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        header = HEADER.format(role=_label(role))
        if role == LEARNED:
            spans.append((at + len(header), at + len(header) + len(text)))
        parts += [header, text, FOOTER]
        at += len(header) + len(text) + len(FOOTER)
    return "".join(parts), spans


def parse(formatted: str) -> list[tuple[str, str]] | None:
    """The turns of a formatted text, unescaped; None if it is not of the grammar."""
    turns, at = [], 0
    while at < len(formatted):
        head = _HEADER.match(formatted, at)
        if head is None:
            return None
        foot = _FOOTER.search(formatted, head.end())
        if foot is None:
            return None
        label = head[1]
        turns.append((_NAMES.get(label) or unquote(label[1:]), unescape(formatted[head.end() : foot.start()])))
        at = foot.start() + len(FOOTER)
    return turns


def format_turns(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """Rendered text that parses back to exactly `turns`, and its loss spans.

    Texts are written as they are first. Each one that does not come back alone is
    escaped; if the whole still differs, all are, which always comes back.
    """
    written = []
    for turn in turns:
        plain = parse(render([turn])[0]) == [turn] and not _CONTROL.search(turn[1])
        written.append((turn[0], turn[1] if plain else escape(turn[1])))
    formatted, spans = render(written)
    if parse(formatted) != turns:
        formatted, spans = render([(role, escape(text)) for role, text in turns])
        if parse(formatted) != turns:
            raise ValueError("the turns cannot be read back")
    return formatted, spans


def masked_text(formatted: str, spans: list[tuple[int, int]]) -> str:
    """All text under the loss mask, unescaped."""
    return "".join(unescape(formatted[a:b]) for a, b in spans)


def format_conversations(
    rows: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """`conv_col`, `formatted`, `loss_spans` (array of begin and end, in code points) per conversation.

    Turns are ordered by number, nulls first, ties by role and text. A null text or role
    is empty; rows with a null conversation id form one conversation; repeated rows are
    repeated turns; an empty table gives an empty result; other columns are ignored.
    One conversation is one text and so one row; nothing else is brought together.
    """
    ship_package(rows.sparkSession)
    turn = F.struct(
        F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    talks = rows.groupBy(conv_col).agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    talks = talks.select(conv_col, F.col("turns.role").alias("roles"), F.col("turns.text").alias("texts"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts, spans = [], []
            for roles, said in zip(batch.column(1), batch.column(2)):
                formatted, loss = format_turns(list(zip(roles.as_py(), said.as_py())))
                texts.append(formatted)
                spans.append([{"begin": a, "end": b} for a, b in loss])
            kind = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.string()), pa.array(spans, kind)],
                names=[conv_col, "formatted", "loss_spans"],
            )

    span = T.StructType([T.StructField("begin", T.LongType()), T.StructField("end", T.LongType())])
    schema = T.StructType(
        [field(talks, conv_col), T.StructField("formatted", T.StringType()), T.StructField("loss_spans", T.ArrayType(span))]
    )
    return talks.mapInArrow(run, schema)
