"""Token counts at every prefix (operator 6).

For a BPE with word ends, the encoding of a prefix has exactly one last token
that fits the encoding before it.  A dynamic programme over the positions of a
word therefore finds the last token and the count of every prefix without
encoding any of them anew: ``count[j] = count[i] + 1`` where the token spanning
``(i, j]`` forms a stable pair with the last token of prefix ``i``.  Counts of a
text's prefixes are those of its words, accumulated.

Defined results: a null text counts as empty (0 bytes, 0 tokens); special
strings inside a text count as the library's default has them, one token each;
counts at prefixes refer to the normalised text (NFC, lower case, runs of white
space as one space).
"""

from __future__ import annotations

import json
import re
from array import array
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator, Sequence
from functools import cache
from itertools import accumulate, repeat

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from quireflow.llm.bpe import byte_alphabet
from quireflow.llm.charclass import find_all, fold
from quireflow.llm.common import chunks, small_batches

#: What a worker remembers; forgetting costs time only.  Chunks of more than LONG characters are not remembered, nor
#: are states beyond SHARED bytes of a word, so every entry is small; the cache is bounded by its characters.
CACHE_CHARS, STATE_ENTRIES, PAIR_ENTRIES = 6_400_000, 1_200_000, 1_000_000
LONG, SHARED = 64, 32


class PrefixCounter:
    """Counts tokens of prefixes for a ``tokenizers`` BPE file with word ends and byte-level symbols."""

    _SPACES = re.compile("[\x1c-\x1f]")

    def __init__(self, spec: dict):
        model = spec["model"]
        self.end = model["end_of_word_suffix"]
        self.special = [t["content"] for t in spec["added_tokens"]]
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.pattern = regex.compile(split["pattern"]["Regex"])
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self.rank = {}
        for i, m in enumerate(model["merges"]):
            self.rank.setdefault(tuple(m if isinstance(m, list) else m.split(" ")), i)
        self.table = dict(enumerate(byte_alphabet()))
        whole = {s for a, b in self.rank for s in (a + b,)}
        singles = set(self.table.values())
        inside = {t for t in whole | singles if t in model["vocab"] and not t.endswith(self.end)}
        at_end = {t[: -len(self.end)] for t in whole | {s + self.end for s in singles} if t in model["vocab"] and t.endswith(self.end)}
        #: Token texts without the word end; number 0 is the empty one.
        self.tokens = ["", *sorted(inside | at_end)]
        #: A token's number, times 4, plus 1 if it occurs inside a word and 2 if at its end.
        self.kind = {t: 4 * i + (t in inside) + 2 * (t in at_end) for i, t in enumerate(self.tokens) if i}
        #: Lengths of the tokens that end in given three characters, the longest first; then 2 and 1.
        ends: dict[str, set[int]] = {}
        for t in self.kind:
            if len(t) > 2:
                ends.setdefault(t[-3:], {1, 2}).add(len(t))
        self.lengths = {e: tuple(sorted(n, reverse=True)) for e, n in ends.items()}
        self.stable: tuple[dict[int, bool], dict[int, bool]] = ({}, {})
        self.states: dict[str, tuple[int, int, int]] = {}
        self.cache: dict[str, Sequence[int]] = {}
        self.older: dict[str, Sequence[int]] = {}
        self.cached = 0

    def merge(self, symbols: list[str]) -> list[str]:
        """Merge the pair of lowest rank, leftmost first, until none is left."""
        rank = self.rank
        while len(symbols) > 1:
            best, at = None, -1
            for i in range(len(symbols) - 1):
                r = rank.get((symbols[i], symbols[i + 1]))
                if r is not None and (best is None or r < best):
                    best, at = r, i
            if best is None:
                break
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
        return symbols

    def _symbols(self, token: str, last: bool) -> list[str]:
        return [*token[:-1], token[-1] + self.end] if last else list(token)

    def _stable(self, left: int, right: int, last: bool) -> bool:
        """Do the two tokens stay apart and whole when their text is encoded together?  (``left`` may be the empty one.)"""
        known = self.stable[last]
        if len(known) >= PAIR_ENTRIES:
            known.clear()
        before, token = self.tokens[left], self.tokens[right]
        want = [x for x in (before, token + self.end if last else token) if x]
        ok = known[left << 20 | right] = self.merge(list(before) + self._symbols(token, last)) == want
        return ok

    def word(self, word: str) -> Sequence[int]:
        """Token counts of all prefixes (1 to all characters) of one pre-token, each ended as a word."""
        if len(word) == 3 and word[0] == "'" and word[1:] in ("re", "ve", "ll"):  # cut short, these are two pre-tokens
            quote = self._run("'")[-1]
            return quote, quote + self._run(word[1])[-1], self._run(word)[-1]
        return self._run(word)

    def _run(self, word: str) -> Sequence[int]:
        mapped = word if word.isascii() and word.isprintable() else word.encode().decode("latin-1").translate(self.table)
        n, states = min(len(mapped), SHARED), self.states
        known = n
        while known and mapped[:known] not in states:
            known -= 1
        if known < n and len(states) + n - known > STATE_ENTRIES:
            states.clear()
            known = 0
        if known == len(mapped):
            ended = [states[mapped[:j]][2] for j in range(1, n + 1)]
        else:
            ended = self._extend(mapped, known)
        if len(word) == len(mapped):
            return tuple(ended) if n == len(mapped) else ended
        return array("q", (ended[e - 1] for e in accumulate(len(c.encode()) for c in word)))

    def _extend(self, mapped: str, known: int) -> Sequence[int]:
        """Counts of all prefixes if ended there, from the states of the first ``known``; remembers those up to SHARED.

        A prefix's state is its last token, its count, and its count if ended
        there: three numbers a position, however long the word is.
        """
        states, kind, lengths, stable = self.states, self.kind.get, self.lengths.get, self._stable
        inner, final = self.stable
        tokens, counts, ends = array("q", [0]), array("q", [0]), array("q")
        for j in range(1, known + 1):
            token, count, end = states[mapped[:j]]
            tokens.append(token)
            counts.append(count)
            ends.append(end)
        for j in range(known + 1, len(mapped) + 1):
            last = ended = None
            for length in lengths(mapped[max(0, j - 3) : j], (2, 1)):
                i = j - length
                k = kind(mapped[i:j]) if i >= 0 else None
                if k is None:
                    continue
                left, n = tokens[i], counts[i]
                token = k >> 2
                key = left << 20 | token
                if last is None and k & 1:
                    ok = inner.get(key)
                    if ok or ok is None and stable(left, token, False):
                        last = token, n + 1
                        if ended is not None:
                            break
                if ended is None and k & 2:
                    ok = final.get(key)
                    if ok or ok is None and stable(left, token, True):
                        ended = n + 1
                        if last is not None:
                            break
            if last is None or ended is None:
                raise ValueError(f"no stable last token for a prefix of {mapped[:j][-80:]!r}")
            tokens.append(last[0])
            counts.append(last[1])
            ends.append(ended)
            if j <= SHARED:
                states[mapped[:j]] = (*last, ended)
        return ends

    def chunk(self, chunk: str) -> Sequence[int]:
        """Counts at all prefixes of a chunk without white space, after normalisation."""
        text = fold(chunk)
        if text.isascii() and text.isalpha():
            return self._run(text)
        out = array("q")
        base = at = 0
        for start, word in find_all(self.pattern, text):
            out.extend(repeat(base, start - at))
            counts = self.word(word)
            out.extend(base + c for c in counts)
            base, at = base + counts[-1], start + len(word)
        out.extend(repeat(base, len(text) - at))
        return tuple(out) if len(out) <= LONG else out

    def _pieces(self, text: str) -> list[str | None]:
        """Chunks between white space; None for a special string."""
        out: list[str | None] = []
        for part in self.cut.split(text) if "<|" in text else [text]:
            if part in self.special:
                out.append(None)
            else:
                out.extend(regex.split(r"\s+", part) if self._SPACES.search(part) else part.split())
        return out

    def _table(self, piece: str) -> Sequence[int]:
        """Counts at the prefixes of a chunk, remembered unless it is long."""
        got = self.cache.get(piece)
        if got is None:
            got = self.older.get(piece) or self.chunk(piece) or (0,)
            if len(piece) <= LONG:
                if self.cached > CACHE_CHARS:  # the entries of one generation more are kept
                    self.older, self.cache, self.cached = self.cache, {}, 0
                self.cache[piece] = got
                self.cached += len(piece) + 8
        return got

    def count(self, text: str) -> int:
        """Tokens of the whole text: the table's last entry."""
        table, n = self._table, 0
        for piece, times in Counter(self._pieces(text)).items():
            n += times * (1 if piece is None else table(piece)[-1])
        return n

    def table_of(self, text: str) -> PrefixTable:
        pieces = self._pieces(text)
        return PrefixTable(pieces, [(1,) if p is None else self._table(p) for p in pieces])


class PrefixTable:
    """Exact token counts at every prefix of one text, by chunk and position in the chunk."""

    def __init__(self, pieces: list[str | None], counts: list[Sequence[int]]):
        self.pieces, self.counts = pieces, counts
        self.before = [0, *accumulate(c[-1] for c in counts)]

    @property
    def total(self) -> int:
        return self.before[-1]

    def at(self, chunk: int, chars: int) -> int:
        """Tokens of the text up to ``chars`` normalised characters of the chunk with this index."""
        return self.before[chunk] + (self.counts[chunk][chars - 1] if chars else 0)

    def cut(self, budget: int) -> tuple[int, int]:
        """The longest prefix (whole chunks, characters of the next) of at most ``budget`` tokens."""
        k = bisect_right(self.before, budget) - 1
        if k >= len(self.counts):
            return k, 0
        left = budget - self.before[k]
        counts = self.counts[k]  # a longer prefix can have fewer tokens, so the last fit is sought from the end
        return k, next((i for i in range(len(counts), 0, -1) if counts[i - 1] <= left), 0)


@cache
def counter_of(spec: str) -> PrefixCounter:
    """One counter for a tokenizer in each worker process, whose memory serves all tasks."""
    return PrefixCounter(json.loads(spec))


def read_spec(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


def count_documents(docs: DataFrame, spec_path: str, limit: int) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of each row's text.

    One map over the scan, no shuffle.  The tokenizer's file is read on the
    driver and broadcast; its size does not depend on the data.
    """
    spark = docs.sparkSession
    small_batches(spark)
    shipped = spark.sparkContext.broadcast(read_spec(spec_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = counter_of(shipped.value)
        for batch in chunks(batches):
            texts = [t or "" for t in batch.column(1).to_pylist()]
            n = [counter.count(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(t.encode()) for t in texts], pa.int64()), pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
