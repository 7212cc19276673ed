"""Token counts of a byte-pair vocabulary, from a transducer whose transitions carry token counts."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The mark that stands for a blank in the vocabulary. Fixed value.
BLANK = "▁"


class Transducer:
    """Counts the tokens of blank-parted words, as the vocabulary's library encodes them.

    The merges of such a vocabulary give a text exactly one encoding, and a sequence of tokens is that encoding
    if and only if each pair of neighbours is: encoding the two tokens' joined text gives the two back. So the last
    token of the encoding of every prefix follows from the last tokens of the shorter prefixes, and what a character
    does depends only on those prefixes after which a token may still be open. Those are the states. They are made
    when first met and numbered; a transition holds the next state and the tokens it adds (or takes back, when a
    character completes a longer token). The machine is deterministic: one table lookup a character once it is warm.
    """

    MAX_STATES, MAX_WORDS, MAX_PAIRS = 250_000, 400_000, 300_000

    def __init__(self, pieces: Iterable[tuple[str, float]]):
        self.rank = {p: -score for p, score in pieces}
        runs = sorted(len(p) for p in self.rank if set(p) == {BLANK})
        longest_run = runs[-1] if runs else 1
        inner = [p for p in self.rank if BLANK in p.lstrip(BLANK) or (p.startswith(BLANK * 2) and p.strip(BLANK))]
        tied = len({r for p, r in self.rank.items() if p.strip(BLANK)}) < sum(1 for p in self.rank if p.strip(BLANK))
        lowest = min((self.rank[BLANK * n] for n in runs if n > 1), default=float("inf"))
        late = all(r < lowest for p, r in self.rank.items() if p.strip(BLANK) and len(p) > 1)
        if inner or tied or not late:
            raise ValueError("this vocabulary merges across words, has equal scores, or merges blanks before words")
        self.longest_run = longest_run
        self.beginnings = {p[:n] for p in self.rank for n in range(len(p))} | {""}
        self.pairs: dict[tuple[str, str], bool] = {}
        self.words: dict[str, int] = {}
        self.runs: dict[int, int] = {0: 0}
        self._clear()

    # -- encoding of short strings, by definition: join the best pair, the leftmost of equals, until none is left

    def _best(self, parts: list[str]) -> int:
        """Which part to join with the next; -1 if none can."""
        best, at, rank = float("inf"), -1, self.rank
        for i in range(len(parts) - 1):
            if (r := rank.get(parts[i] + parts[i + 1], best)) < best:
                best, at = r, i
        return at

    def _merged(self, parts: list[str]) -> list[str]:
        while (i := self._best(parts)) >= 0:
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def _neighbours(self, a: str, b: str) -> bool:
        """If the encoding of the joined text is just these two tokens: no merge reaches across, and each becomes whole."""
        known = self.pairs.get((a, b))
        if known is None:
            if len(self.pairs) > self.MAX_PAIRS:
                self.pairs.clear()
            parts, border = [*a, *b], len(a)
            while (i := self._best(parts)) >= 0 and i != border - 1:
                parts[i : i + 2] = [parts[i] + parts[i + 1]]
                border -= i < border
            known = self.pairs[a, b] = i < 0 and len(parts) == 2
        return known

    def _run(self, blanks: int) -> int:
        """Tokens of blanks alone. They merge from the left; beyond a few of the longest run the count is periodic."""
        further = max(0, blanks // self.longest_run - 3)
        rest = blanks - further * self.longest_run
        if rest not in self.runs:
            self.runs[rest] = len(self._merged([BLANK] * rest))
        return self.runs[rest] + further

    # -- states

    def _clear(self) -> None:
        #: per state: the longest end of the text that begins some longer token; per position from there on the prefix
        #: that ends at it (last token, tokens relative to here, if the first token is a bare blank), or None where no
        #: token can begin any more
        self.states: list[tuple[str, tuple]] = [("", ((None, 0, False),))]
        self.numbers = {self.states[0]: 0}
        self.moves: list[dict[str, tuple[int, int]]] = [{}]

    def _size(self, token: str) -> int:
        return 1 if token in self.rank else len(token.encode("utf-8", "surrogatepass"))

    def _step(self, state: int, char: str) -> tuple[int, int]:
        """The transition of ``state`` on ``char``, made and kept."""
        tail, prefixes = self.states[state]
        tail += char
        for n in range(len(tail), 0, -1):
            token, prefix = tail[-n:], prefixes[-n]
            if prefix is None or (n > 1 and token not in self.rank):
                continue
            before, count, bare = prefix
            if self._whole(token) if before is None else self._neighbours(before, token):
                added = count + self._size(token)
                last = (token, added, token == BLANK if before is None else bare)
                break
        else:
            raise AssertionError("no encoding")
        n = next(n for n in range(len(tail), -1, -1) if tail[len(tail) - n :] in self.beginnings)
        kept = []
        for k in range(n, 0, -1):  # the position k characters back
            prefix = prefixes[-k]
            alive = prefix is not None and tail[len(tail) - k :] in self.beginnings
            kept.append((prefix[0], prefix[1] - added, prefix[2]) if alive else None)
        number = self._number((tail[len(tail) - n :], (*kept, (last[0], 0, last[2]))))
        self.moves[state][char] = (number, added)
        return number, added

    def _number(self, state: tuple[str, tuple]) -> int:
        number = self.numbers.get(state)
        if number is None:
            number = self.numbers[state] = len(self.states)
            self.states.append(state)
            self.moves.append({})
        return number

    def _whole(self, token: str) -> bool:
        known = self.pairs.get((token, ""))
        if known is None:
            known = self.pairs[token, ""] = self._merged(list(token)) == [token]
        return known

    def _body(self, body: str) -> tuple[int, bool]:
        """Tokens of a word with its blank in front, and if that blank stays a token of its own."""
        state, total = 0, 0
        for char in body:
            move = self.moves[state].get(char)
            if move is None:
                if len(self.states) > self.MAX_STATES:  # forget all states but this one
                    here = self.states[state]
                    self._clear()
                    state = self._number(here)
                move = self._step(state, char)
            state, n = move
            total += n
        return total, self.states[state][1][-1][2]

    def word(self, word: str) -> int:
        """Twice the tokens of a word with one blank in front, plus one if that blank stays a token of its own."""
        known = self.words.get(word)
        if known is None:
            if len(self.words) > self.MAX_WORDS:
                self.words.clear()
            n, bare = self._body(BLANK + word)
            known = 2 * n + bare
            if len(word) <= 64:
                self.words[word] = known
        return known

    def count_word(self, word: str) -> int:
        """Tokens of blanks followed by other characters (either may be missing)."""
        body = word.lstrip(BLANK)
        blanks = len(word) - len(body)
        if not body:
            return self._run(blanks)
        if not blanks:
            return self._body(body)[0]
        n, bare = divmod(self.word(body), 2)
        # blanks merge with blanks last of all, when the word's own merges are done
        return n - 1 + self._run(blanks) if bare else n + self._run(blanks - 1)

    def count_words(self, words: list[str]) -> int:
        return sum(n * self.count_word(word) for word, n in Counter(words).items())

    def count_texts(self, texts: list[str]) -> np.ndarray:
        """Tokens of many texts at once: words are told apart by Arrow, each different one is counted once."""
        parts = pc.split_pattern(pc.replace_substring(pa.array(texts, pa.large_string()), BLANK, " "), " ")
        ends = parts.offsets.to_numpy()[1:]
        coded = parts.values.dictionary_encode()
        which = coded.indices.to_numpy()
        words = coded.dictionary.to_pylist()
        code = np.fromiter((self.word(w) if w else 0 for w in words), np.int64, len(words))[which]
        n = code >> 1
        first = np.zeros(len(code), bool)
        first[0], first[ends[:-1]] = True, True
        # an empty word is one more blank before the next word, or a blank at the end of the text
        if (empty := code == 0).any():
            at = np.arange(len(code))
            start = np.maximum.accumulate(np.where(~empty | first, at, 0))  # last full word, or first word, up to here
            for i in np.flatnonzero(empty & np.append(~empty[1:] | first[1:], True)):  # last of a run of empty words
                blanks = int(i - start[i] + (1 if empty[start[i]] else 0))
                if i + 1 < len(code) and not first[i + 1]:
                    n[i + 1] += self._run(blanks + 1) - 1 if code[i + 1] & 1 else self._run(blanks)
                else:
                    n[i] = self._run(blanks)
        sums = np.concatenate([[0], np.cumsum(n)])
        return sums[ends] - sums[np.concatenate([[0], ends[:-1]])]


#: A word: its blanks and what follows up to the next blank; or blanks at the end.
_WORDS = re.compile(f"{BLANK}*[^{BLANK}]+|{BLANK}+")
#: Where no token reaches across: before a blank that follows another character.
_CUT = re.compile(f"(?<=[^{BLANK}])(?={BLANK})")


class ChunkMap:
    """What a chunk of text does to any state before it: (tail before, tokens before) -> (tail after, tokens after).

    At its first cut the machine is back in its start state, whatever came before. So the map is known by the
    characters before the first cut (``head``), the tokens between first and last cut, and the characters after the
    last cut (``tail``); without a cut everything is ``head`` and ``tail`` is None.
    """

    __slots__ = ("head", "count", "tail")

    def __init__(self, head: str, count: int = 0, tail: str | None = None):
        self.head, self.count, self.tail = head, count, tail


def chunk_map(machine: Transducer, chunk: str) -> ChunkMap:
    cut = _CUT.search(chunk)
    if cut is None:
        return ChunkMap(chunk)
    at = cut.start()
    last = chunk.rfind(BLANK)
    while last > at and chunk[last - 1] == BLANK:
        last -= 1
    last = max(last, at)
    return ChunkMap(chunk[:at], machine.count_words(_WORDS.findall(chunk, at, last)), chunk[last:])


def compose(machine: Transducer, a: ChunkMap, b: ChunkMap) -> ChunkMap:
    """The map of chunk ``a`` followed by chunk ``b``; associative.

    A cut can also lie just between the two: after a character that is no blank, before a blank."""
    left = a.head if a.tail is None else a.tail
    if left and b.head + (b.tail or ""):
        first = b.head[:1] or b.tail[:1]
        if left[-1] != BLANK and first == BLANK:
            b_all = b if b.tail is not None else ChunkMap("", 0, b.head)
            if b.tail is not None and b.head:  # b's own head starts after this cut: it is whole words now
                b_all = ChunkMap("", machine.count_words([b.head]) + b.count, b.tail)
            if a.tail is None:
                return ChunkMap(a.head, b_all.count, b_all.tail)
            return ChunkMap(a.head, a.count + machine.count_words([a.tail]) + b_all.count, b_all.tail)
    if a.tail is None:
        return ChunkMap(a.head + b.head, b.count, b.tail)
    if b.tail is None:
        return ChunkMap(a.head, a.count, a.tail + b.head)
    return ChunkMap(a.head, a.count + machine.count_words([a.tail + b.head]) + b.count, b.tail)


def scan_maps(machine: Transducer, maps: list[ChunkMap]) -> ChunkMap:
    """The composition of all maps as a balanced tree: neighbours are joined in rounds, log2(n) of them."""
    while len(maps) > 1:
        maps = [reduce(lambda a, b: compose(machine, a, b), maps[i : i + 2]) for i in range(0, len(maps), 2)]
    return maps[0]


#: Characters of short texts that are counted at once.
TOGETHER = 16_000_000


def count_long(machine: Transducer, text: str, chunk_chars: int) -> int:
    """Tokens of a text by chunks."""
    line = BLANK + text.replace(" ", BLANK)
    whole = scan_maps(machine, [chunk_map(machine, line[i : i + chunk_chars]) for i in range(0, len(line), chunk_chars)])
    return machine.count_words(_WORDS.findall(whole.head)) + whole.count + machine.count_words(_WORDS.findall(whole.tail or ""))


def count_tokens(machine: Transducer, texts: Iterable[str | None], chunk_chars: int = 65_536) -> list[int]:
    """Tokens of whole texts; null and empty texts have none. Texts of one chunk are counted together, longer ones
    chunk by chunk, the chunks' maps composed."""
    out: list[int] = []
    short: list[tuple[int, str]] = []
    held = 0

    def flush() -> None:
        if short:
            for (i, _), n in zip(short, machine.count_texts([t for _, t in short]), strict=True):
                out[i] = int(n)
            short.clear()

    for text in texts:
        out.append(0)
        if text and len(text) >= chunk_chars:
            out[-1] = count_long(machine, text, chunk_chars)
        elif text:
            short.append((len(out) - 1, text))
            held += len(text)
            if held >= TOGETHER:
                flush()
                held = 0
    flush()
    return out


def read_pieces(model_bytes: bytes) -> list[tuple[str, float]]:
    """The vocabulary of a model file: its ordinary pieces with their scores, read by the model's own library.

    Only byte-pair models that keep texts as they are, put a blank in front and spell unknown characters in bytes
    are taken."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_proto=model_bytes)
    if model.encode("", out_type=str) or "".join(model.encode("  a  b ", out_type=str)) != f"{BLANK * 3}a{BLANK * 2}b{BLANK}":
        raise ValueError("this model changes white space")
    return [
        (model.id_to_piece(i), model.get_score(i))
        for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
    ]


_machines: dict[int, Transducer] = {}


def token_counter(model_bytes: bytes, chunk_chars: int = 65_536):
    """A column function: text -> token count. The model file's bytes (half a megabyte) travel with the task; the
    machine is compiled once per Python worker, and its tables are bounded."""
    key = hash(model_bytes)

    @F.pandas_udf("long")
    def counted(text: pd.Series) -> pd.Series:
        if key not in _machines:
            _machines.clear()
            _machines[key] = Transducer(read_pieces(model_bytes))
        machine = _machines[key]
        return pd.Series(count_tokens(machine, text, chunk_chars), dtype="int64")

    return counted


def count_document_tokens(docs: DataFrame, model_bytes: bytes, id_col: str = "doc_id", text_col: str = "text", limit: int = 4096) -> DataFrame:
    """One row per document: id, n_bytes (UTF-8), n_tokens, over_limit.

    Counts are those of the model's own library without begin, end or added special tokens. Null counts as empty, with
    no bytes and no tokens. Texts are cut into chunks whose maps are composed, so memory follows one text. No shuffle;
    repeated rows are counted each; an empty table gives an empty result; other columns are not read.
    """
    text: Column = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col), F.octet_length(text).cast("long").alias("n_bytes"), token_counter(model_bytes)(text).alias("n_tokens"))
    return rows.withColumn("over_limit", F.col("n_tokens") > limit)
