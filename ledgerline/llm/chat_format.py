"""Chat formatting: conversations as token ids with a loss mask, assembled segment by segment, and read back from those."""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import materialise

#: Turns whose numbers share all but the lowest bits are numbered together.
TURN_BITS = 6


@dataclass(frozen=True)
class Template:
    """Control strings. A conversation opens with ``begin``; a turn is ``user`` or ``system`` around its text, or a text closed
    by ``end``: an assistant's stands alone, any other role is named between ``role`` first. No control string may be
    a suffix of another's beginning, so that occurrences never overlap."""

    begin: str = "<s>"
    end: str = "</s>"
    user: tuple[str, str] = ("[INST]", "[/INST]")
    system: tuple[str, str] = ("<<SYS>>", "<</SYS>>")
    role: tuple[str, str] = ("[ROLE]", "[/ROLE]")

    @property
    def controls(self) -> tuple[str, ...]:
        return (self.begin, self.end, *self.user, *self.system, *self.role)

    def _rest(self) -> dict[str, list[str]]:
        by_first: dict[str, list[str]] = {}
        for c in self.controls:
            by_first.setdefault(c[0], []).append(re.escape(c[1:]))
        return by_first

    def escape(self, text: str) -> str:
        """Puts a backslash after the first character of every control string, and of every one that has backslashes there already."""
        return _patterns(self)[0].sub("\\\\", text)

    def unescape(self, text: str) -> str:
        """Takes one backslash from each again."""
        return _patterns(self)[1].sub("", text)

    def ids(self, first: int) -> dict[str, int]:
        """Reserved ids of the control strings, from ``first`` on."""
        return {c: first + i for i, c in enumerate(self.controls)}


@cache
def _patterns(template: Template) -> tuple[re.Pattern, re.Pattern]:
    parts = [(re.escape(c), "|".join(rest)) for c, rest in template._rest().items()]
    put = "|".join(rf"(?<={c})(?=\\*(?:{rest}))" for c, rest in parts)
    take = "|".join(rf"(?<={c})\\(?=\\*(?:{rest}))" for c, rest in parts)
    return re.compile(put), re.compile(take)


@dataclass(frozen=True)
class Vocabulary:
    """A byte-level vocabulary as the lines of its file (token in base 64, rank) and its pattern; sent with the tasks."""

    lines: bytes
    pattern: str

    @property
    def size(self) -> int:
        return max(int(line.split()[1]) for line in self.lines.splitlines()) + 1


@cache
def _encoding(vocabulary: Vocabulary):
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, vocabulary.lines.splitlines())}
    return tiktoken.Encoding("chat", pat_str=vocabulary.pattern, mergeable_ranks=ranks, special_tokens={})


def _encode(vocabulary: Vocabulary, template: Template, first: int):
    """Batches of (conv_id, turn, role, text) -> (conv_id, turn, ids, mask): segments are encoded one by one, so no
    text can give a reserved id; the ids of the control strings go between them. The mask is the running sum of +1
    where an assistant's text begins and -1 where it ends."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, ids = _encoding(vocabulary).encode_ordinary, template.ids(first)
        for batch in batches:
            stream, ends, marks = [], [], []
            for role, text in zip(batch.column("role").to_pylist(), batch.column("text").to_pylist(), strict=True):
                body = tokens(template.escape(text or ""))
                if role == "user":
                    opened, closed = [ids[template.user[0]]], ids[template.user[1]]
                elif role == "system":
                    opened, closed = [ids[template.system[0]]], ids[template.system[1]]
                elif role == "assistant":
                    opened, closed = [], ids[template.end]
                    marks.append((len(stream), len(stream) + len(body)))
                else:
                    opened, closed = [ids[template.role[0]], *tokens(template.escape(role or "")), ids[template.role[1]]], ids[template.end]
                stream += opened + body
                stream.append(closed)
                ends.append(len(stream))
            steps = np.zeros(len(stream) + 1, np.int8)
            for begin, end in marks:
                steps[begin] += 1
                steps[end] -= 1
            offsets = pa.array(np.array([0, *ends], np.int32))
            lists = [pa.ListArray.from_arrays(offsets, pa.array(v)) for v in (np.array(stream, np.int32), np.cumsum(steps[:-1], dtype=np.int8))]
            yield pa.RecordBatch.from_arrays([batch.column("conv_id"), batch.column("turn"), *lists], ["conv_id", "turn", "ids", "mask"])

    return encode


def _decode(vocabulary: Vocabulary, template: Template, first: int):
    """Turns' ids and masks -> (conv_id, turn_no, said: role, line feed, text, line feed; learned: text under the mask;
    learned_chars, formatted_chars). What it returns is read from ids and mask alone."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bytes_of, ids = _encoding(vocabulary).decode_bytes, template.ids(first)
        texts = {i: c for c, i in ids.items()}
        role_of = {ids[template.user[0]]: "user", ids[template.system[0]]: "system"}

        def plain(segment: np.ndarray) -> str:
            return bytes_of(segment.tolist()).decode()

        for batch in batches:
            said, learned, learned_chars, formatted_chars = [], [], [], []
            lists = [batch.column(c) for c in ("ids", "mask")]
            values = [x.flatten().to_numpy() for x in lists]
            ends = np.cumsum(np.array(lists[0].value_lengths().to_numpy(zero_copy_only=False), np.int64))
            for begin, end in zip(np.concatenate([[0], ends[:-1]]) if len(ends) else [], ends, strict=True):
                stream, mask = values[0][begin:end], values[1][begin:end]
                cuts = np.flatnonzero(stream >= first)
                segments = [plain(s[s < first]) for s in np.split(stream, cuts)]
                formatted_chars.append(sum(map(len, segments)) + sum(len(texts[int(i)]) for i in stream[cuts]))
                marks = [int(i) for i in stream[cuts] if i != ids[template.begin]]
                if marks[0] == ids[template.role[0]]:
                    role, text = segments[-3], segments[-2]
                else:
                    role, text = role_of.get(marks[0], "assistant"), segments[-2]
                said.append(f"{template.unescape(role)}\n{template.unescape(text)}\n".encode())
                under = template.unescape(plain(stream[mask > 0]))
                learned.append(under.encode())
                learned_chars.append(len(under))
            more = [pa.array(said, pa.binary()), pa.array(learned, pa.binary()), pa.array(learned_chars, pa.int64()), pa.array(formatted_chars, pa.int64())]
            yield pa.RecordBatch.from_arrays([batch.column("conv_id"), batch.column("turn_no"), *more], ["conv_id", "turn_no", "said", "learned", "learned_chars", "formatted_chars"])

    return decode


def _fold():
    """Rows in the order of conversations and turns -> a row per conversation; only running digests are held."""

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        state, type_ = None, None

        def done(rows: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], type_), *(pa.array([r[i] for r in rows]) for i in range(1, 6))], names)

        def closed(s) -> tuple:
            return (s[0], s[1], s[2].hexdigest(), s[3], s[4].hexdigest(), s[5])

        for batch in batches:
            rows, type_ = [], batch.column("conv_id").type
            for conv, said, learned, chars, formatted in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "said", "learned", "learned_chars", "formatted_chars")), strict=True):
                if state is None or state[0] != conv:
                    if state:
                        rows.append(closed(state))
                    state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                state[1] += 1
                state[2].update(said)
                state[3] += chars
                state[4].update(learned)
                state[5] += formatted
            if rows:
                yield done(rows)
        if state:
            yield done([closed(state)])

    return fold


def _before(value: Column | str, window) -> Column:
    return F.coalesce(F.sum(value).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def _same(*names: str) -> Column:
    """Equal keys of a table and its sums, nulls equal."""
    out = F.lit(True)
    for n in names:
        out = out & F.col(n).eqNullSafe(F.col(f"of_{n}"))
    return out


def format_conversations(rows: DataFrame, vocabulary: Vocabulary, template: Template = Template()) -> DataFrame:
    """One row per turn, which together are the formatted conversations: conv_id, turn_no (from 0), first_token (tokens of the
    conversation before it), ids array<int>, mask array<tinyint> (1: learned).

    ``rows`` has conv_id, turn (a whole number), role and text; other columns are ignored, whatever their names. A null
    text or role counts as empty; roles other than user, assistant and system are spelled out. Rows of a conversation
    go by turn, null first; rows of one turn by their ids, so repeated rows are repeated turns and any order of the
    input gives the same output. A null conv_id is a conversation of its own. An empty table gives an empty table.

    Texts are escaped and encoded on their own in the scan's tasks, without the shuffle of any text; reserved ids
    start behind the vocabulary. Turns are numbered in two levels: sums per 2 ** TURN_BITS turn numbers first, so that
    a conversation with a third of all rows is dealt to many tasks; only its sums meet in one.
    """
    first = vocabulary.size
    kind = rows.schema["conv_id"].dataType.simpleString()
    picked = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    encoded = picked.mapInArrow(_encode(vocabulary, template, first), f"conv_id {kind}, turn long, ids array<int>, mask array<tinyint>")
    encoded = materialise(encoded, "op11-encoded").withColumn("grp", F.shiftright("turn", TURN_BITS))
    sums = encoded.groupBy("conv_id", "grp").agg(F.count("*").alias("turns"), F.sum(F.size("ids")).alias("tokens"))
    whole = Window.partitionBy("conv_id").orderBy("grp")
    sums = sums.select(F.col("conv_id").alias("of_conv_id"), F.col("grp").alias("of_grp"), _before("turns", whole).alias("turns_before"), _before("tokens", whole).alias("tokens_before"))
    inside = Window.partitionBy("conv_id", "grp").orderBy("turn", "ids")
    placed = encoded.withColumns({"place": F.row_number().over(inside) - 1, "inner": _before(F.size("ids"), inside)})
    turn_no = (F.col("turns_before") + F.col("place")).cast("long")
    opened = turn_no == 0
    begin = template.ids(first)[template.begin]
    return placed.join(sums.hint("merge"), _same("conv_id", "grp")).select(
        "conv_id",
        turn_no.alias("turn_no"),
        (F.col("tokens_before") + F.col("inner") + F.when(opened, 0).otherwise(1)).cast("long").alias("first_token"),
        F.when(opened, F.concat(F.array(F.lit(begin)), "ids")).otherwise(F.col("ids")).alias("ids"),
        F.when(opened, F.concat(F.array(F.lit(0).cast("tinyint")), "mask")).otherwise(F.col("mask")).alias("mask"),
    )


def read_back(formatted: DataFrame, vocabulary: Vocabulary, template: Template = Template()) -> DataFrame:
    """Per conversation, from ids and masks alone: conv_id, n_turns, turns_sha256 (role, line feed, text, line feed of every
    turn), loss_chars and loss_sha256 (all text under the mask, unescaped, nothing between), formatted_chars (code points of
    the formatted text, control strings included).

    Tokens are decoded in the tasks that read them. A digest has to see its conversation in order: that is one task's
    work, done on sorted rows one by one, so its memory does not grow with the conversation.
    """
    kind = formatted.schema["conv_id"].dataType.simpleString()
    schema = f"conv_id {kind}, turn_no long, said binary, learned binary, learned_chars long, formatted_chars long"
    turns = formatted.select("conv_id", "turn_no", "ids", "mask").mapInArrow(_decode(vocabulary, template, vocabulary.size), schema)
    ordered = turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn_no")
    return ordered.mapInArrow(_fold(), f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def formatted_text(ids: list[int], vocabulary: Vocabulary, template: Template = Template()) -> str:
    """The formatted text of some ids, control strings spelled out."""
    first = vocabulary.size
    texts = {i: c for c, i in template.ids(first).items()}
    stream = np.array(ids, np.int64)
    out = []
    for s in np.split(stream, np.flatnonzero(stream >= first)):
        out.append("".join(texts[int(i)] for i in s[s >= first]) + _encoding(vocabulary).decode_bytes(s[s < first].tolist()).decode())
    return "".join(out)
