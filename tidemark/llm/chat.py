r"""Chat formatting by schema fingerprints.

A record's nested field paths, with list positions left out, are hashed; the hash selects a declarative mapping
from that layout to canonical turns. Records of an unknown layout are reported, not guessed at. The template
writes a turn as

    ### <role>:
    <text></turn>

and puts a backslash before each backslash, `#` and `<` of roles and texts, and each `:` of roles, so no text can hold a control string,
and reading back is exact. The loss mask holds the character spans of the assistant texts in the output.

Null roles and texts count as empty. A record without turns gives an empty text and an empty mask. One conversation is
one row of output, so its turns meet in one row; conversations are independent of each other.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import cells, in_batches, map_arrow

_ESCAPED = re.compile(r"[\\#<]")
_ESCAPED_ROLE = re.compile(r"[\\#<:]")
_UNESCAPED = re.compile(r"\\(.)", re.S)
#: In the output an unescaped "### " begins a turn, and an unescaped "</turn>" ends it.
_TURN = re.compile(r"### ([^\\:]*(?:\\.[^\\:]*)*):\n([^\\<]*(?:\\.[^\\<]*)*)</turn>\n", re.S)


def field_paths(value, path: str = "") -> set[str]:
    """Paths of all fields below a JSON value; list items share the path of their list."""
    if isinstance(value, dict):
        return set().union(*(field_paths(child, f"{path}.{name}" if path else name) for name, child in value.items())) if value else {path}
    if isinstance(value, list):
        return set().union(*(field_paths(child, f"{path}[]") for child in value)) if value else {f"{path}[]"}
    return {path}


def fingerprint(paths: set[str]) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()[:16]


#: Other names of the canonical roles, in layouts that use them.
OTHER_NAMES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}

#: Layouts: the field paths, and either a list of turns with its role and text field and names that roles have there, or
#: fields with their roles.
LAYOUTS: list[tuple[set[str], dict]] = [
    ({"messages[].role", "messages[].content"}, {"turns": "messages", "role": "role", "text": "content"}),
    ({"messages[]"}, {"turns": "messages", "role": "role", "text": "content"}),
    ({"dialog[].role", "dialog[].text"}, {"turns": "dialog", "role": "role", "text": "text"}),
    ({"conversations[].from", "conversations[].value"}, {"turns": "conversations", "role": "from", "text": "value", "names": OTHER_NAMES}),
    ({"turns[].speaker.name", "turns[].text"}, {"turns": "turns", "role": "speaker.name", "text": "text", "names": OTHER_NAMES}),
    ({"prompt", "response"}, {"fields": [("user", ["prompt"]), ("assistant", ["response"])]}),
    ({"prompt", "completion"}, {"fields": [("user", ["prompt"]), ("assistant", ["completion"])]}),
    ({"system", "prompt", "response"}, {"fields": [("system", ["system"]), ("user", ["prompt"]), ("assistant", ["response"])]}),
    ({"instruction", "output"}, {"fields": [("user", ["instruction"]), ("assistant", ["output"])]}),
    ({"instruction", "input", "output"}, {"fields": [("user", ["instruction", "input"]), ("assistant", ["output"])]}),
    ({"system", "instruction", "output"}, {"fields": [("system", ["system"]), ("user", ["instruction"]), ("assistant", ["output"])]}),
    ({"question", "answer"}, {"fields": [("user", ["question"]), ("assistant", ["answer"])]}),
]


def mappings(layouts: list[tuple[set[str], dict]] | None = None) -> dict[str, dict]:
    return {fingerprint(paths): mapping for paths, mapping in layouts or LAYOUTS}


def _at(value, path: str):
    for name in path.split("."):
        value = value.get(name) if isinstance(value, dict) else None
    return value


def _text(value) -> str:
    return "" if value is None else value if isinstance(value, str) else json.dumps(value, ensure_ascii=False, sort_keys=True)


def canonical_turns(record, mapping: dict) -> list[tuple[str, str]]:
    if "turns" in mapping:
        names = mapping.get("names", {})
        found = [(_text(_at(turn, mapping["role"])), _text(_at(turn, mapping["text"]))) for turn in record.get(mapping["turns"]) or []]
        return [(names.get(role, role), text) for role, text in found]
    return [(role, "\n".join(text for name in fields if (text := _text(record.get(name))))) for role, fields in mapping["fields"]]


def escape(text: str) -> str:
    return _ESCAPED.sub(r"\\\g<0>", text)


def unescape(text: str) -> str:
    return _UNESCAPED.sub(r"\1", text)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted text and the spans under the loss mask."""
    out, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"### {_ESCAPED_ROLE.sub(r'\\\g<0>', role)}:\n", escape(text)
        if role == "assistant":
            spans.append((at + len(head), at + len(head) + len(body)))
        out += [head, body, "</turn>\n"]
        at += len(head) + len(body) + 8
    return "".join(out), spans


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns, read back from formatted text alone."""
    turns, at = [], 0
    while at < len(formatted):
        found = _TURN.match(formatted, at)
        if found is None:
            raise ValueError(f"no turn at character {at}")
        turns.append((unescape(found[1]), unescape(found[2])))
        at = found.end()
    return turns


_OUT = "key bigint, layout string, known boolean, formatted string, mask array<struct<start:bigint,stop:bigint>>"
_OUT_ARROW = pa.schema(
    [("key", pa.int64()), ("layout", pa.string()), ("known", pa.bool_()), ("formatted", pa.string()), ("mask", pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])))]
)


def _format(batches: Iterator[pa.RecordBatch], known: dict[str, dict]) -> Iterator[pa.RecordBatch]:
    def rows():
        for batch in batches:
            for key, text in cells(batch, "key", "record"):
                try:
                    record = json.loads(text or "null", strict=False)
                except ValueError:
                    record = None
                layout = fingerprint(field_paths(record)) if isinstance(record, dict) else None
                if layout in known:
                    formatted, spans = render(canonical_turns(record, known[layout]))
                    yield key, layout, True, formatted, [{"start": a, "stop": b} for a, b in spans]
                else:
                    yield key, layout, False, None, None

    return in_batches(rows(), _OUT_ARROW)


def format_records(records: DataFrame, layouts: list[tuple[set[str], dict]] | None = None) -> DataFrame:
    """key, layout, known, formatted and mask for each row of records (key bigint, record: a JSON object as text).

    A record whose layout has no mapping, or that isn't a JSON object, has known false and null text and mask.
    """
    return records.select("key", "record").transform(map_arrow, partial(_format, known=mappings(layouts)), _OUT)


def unknown_layouts(formatted: DataFrame) -> DataFrame:
    """layout (null where the record is no JSON object) and n, the records that format_records() had no mapping for."""
    return formatted.where(~F.col("known")).groupBy("layout").agg(F.count("*").alias("n"))


def rows_to_records(turns: DataFrame) -> DataFrame:
    """key and record for conversations stored a turn a row (conv_id, turn, role, text), in order of turn, role and text.

    The layout follows from the roles, as in corpora put together from several sources: question and answer as prompt and
    response, with a system turn before them or not, and any other conversation as a list of messages or a dialog.
    """
    picked = turns.selectExpr("cast(conv_id as bigint) key", "cast(turn as bigint) turn", "coalesce(role, '') role", "coalesce(text, '') text")
    grouped = picked.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("t"))
    are = lambda *roles: F.col("t.role") == F.array(*(F.lit(role) for role in roles))
    text = lambda k: F.col("t")[k]["text"]
    listed = lambda role, content: F.transform("t", lambda turn: F.struct(turn["role"].alias(role), turn["text"].alias(content)))
    record = (
        F.when(are("user", "assistant"), F.to_json(F.struct(text(0).alias("prompt"), text(1).alias("response"))))
        .when(are("system", "user", "assistant"), F.to_json(F.struct(text(0).alias("system"), text(1).alias("prompt"), text(2).alias("response"))))
        .when(F.col("key") % 2 == 0, F.to_json(F.struct(listed("role", "content").alias("messages"))))
        .otherwise(F.to_json(F.struct(listed("role", "text").alias("dialog"))))
    )
    return grouped.select("key", record.alias("record"))


_BACK = "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
_BACK_ARROW = pa.schema(
    [("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())]
)


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows():
        for batch in batches:
            for key, formatted, mask in cells(batch, "key", "formatted", "mask"):
                turns = parse(formatted)
                whole = "".join(f"{role}\n{text}\n" for role, text in turns)
                loss = "".join(unescape(formatted[span["start"] : span["stop"]]) for span in mask)
                yield key, len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(formatted)

    return in_batches(rows(), _BACK_ARROW)


def read_back(formatted: DataFrame) -> DataFrame:
    """Counts and digests of turns and loss text, from formatted text and mask alone; unknown layouts are left out and counted by unknown_layouts()."""
    return formatted.where("known").select("key", "formatted", "mask").transform(map_arrow, _digest, _BACK)


def oracle_sql() -> str:
    """DuckDB SQL for the registered query."""
    return r"""
WITH c AS (SELECT conv_id::bigint AS conv_id, turn::bigint AS turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, unnest([0, 1]), unnest(['user', 'assistant']), '\### Assistant: </turn> ok'),
t AS (SELECT *, length(role) + length(regexp_replace(role, '[^\\#<:]', '', 'g')) + length(text) + length(regexp_replace(text, '[^\\#<]', '', 'g')) + 14 AS chars FROM c)
SELECT conv_id, count(*)::bigint AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::bigint AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256, sum(chars)::bigint AS formatted_chars
FROM t GROUP BY conv_id
"""
