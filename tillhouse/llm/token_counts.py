"""Exact token counts of every prefix of a text, by dynamic programming.

In byte-pair encoding the last token of a prefix is unique: of all tokens that
end there, only one both follows a correctly encoded shorter prefix and forms
with that prefix's last token a pair that merging would leave apart. So one pass
over a piece gives the exact count at each of its prefixes:
count(i) = count(i - length of the last token) + 1.

The counts are kept as differences from character to character. Any budget or
truncation question is then a running sum, with no text encoded again.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator
from functools import cache
from operator import sub

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillhouse.llm.columns import map_batches, texts
from tillhouse.llm.vocabulary import LATIN_SPACE, SPACE, Splitter, byte_alphabet, read_file

LIMIT = 512
CACHED_PIECES = 500_000
LONG_PIECE = 64
TOGETHER = 2_000_000
NEVER = 1 << 60
CACHED_PAIRS = 1_000_000
PREFIXES_PER_ROW = 1 << 16
STEP = np.dtype("<i2")
SPACES = re.compile(f"[{SPACE}]{{2,}}(?=[^{SPACE}])")


class PrefixCounter:
    """Token counts at every character prefix, for one byte-level vocabulary."""

    def __init__(self, source: str):
        self.splitter = Splitter(source)
        model = json.loads(source)["model"]
        to_byte = byte_alphabet()
        tokens = [bytes(map(to_byte.get, t)) for t in model["vocab"] if set(t) <= to_byte.keys()]
        self.names = tokens
        self.number = {token: k for k, token in enumerate(tokens)}
        self.base = len(tokens)
        self.ranks: dict[int, int] = {}
        self.split: dict[int, tuple[int, int, int]] = {}
        for rank, merge in enumerate(model["merges"]):
            left, right = (bytes(map(to_byte.get, part)) for part in (merge if isinstance(merge, list) else merge.split(" ")))
            l, r = self.number[left], self.number[right]
            self.ranks[l * self.base + r] = rank
            self.split.setdefault(self.number[left + right], (l, r, rank))
        # Tokens by their bytes from last to first; -1 holds the token that ends there.
        self.endings: dict = {}
        for token, k in self.number.items():
            node = self.endings
            for byte in reversed(token):
                node = node.setdefault(byte, {})
            node[-1] = k
        self.apart: dict[int, bool] = {}
        self.reached: dict[int, bool] = {}
        self.edges: tuple[dict, dict] = ({}, {})
        self.steps: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """The tokens that stand at one edge while `token` is merged, last first, each with the rank that ends it."""
        known = self.edges[side].get(token)
        if known is None:
            known, at, end = [(token, NEVER)], token, NEVER
            while at in self.split:
                left, right, end = self.split[at]
                at = left if side == 0 else right
                known.append((at, end))
            self.edges[side][token] = known
        return known

    def _stay_apart(self, left: int, right: int) -> bool:
        """Whether merging the bytes of two tokens ends in just these tokens.

        It does unless some two tokens that stand on either side of the boundary
        at the same time would merge before one of them is merged away from it.
        """
        ours, theirs = self._edge(left, 1), self._edge(right, 0)
        a, b = len(ours) - 1, len(theirs) - 1
        while True:
            (x, x_end), (y, y_end) = ours[a], theirs[b]
            rank = self.ranks.get(x * self.base + y, NEVER)
            if rank < x_end and rank <= y_end and rank < NEVER:
                return False
            if x_end == y_end == NEVER:
                return True
            if x_end <= y_end:
                a -= 1
            else:
                b -= 1

    def _merges_to_itself(self, token: int, data: bytes) -> bool:
        known = self.reached.get(token)
        if known is None:
            parts = [self.number[data[k : k + 1]] for k in range(len(data))]
            while len(parts) > 1:
                ranked = [self.ranks.get(x * self.base + y, NEVER) for x, y in zip(parts, parts[1:])]
                rank = min(ranked)
                if rank == NEVER:
                    break
                at = ranked.index(rank)
                parts[at : at + 2] = [self.number[self.names[parts[at]] + self.names[parts[at + 1]]]]
            known = self.reached[token] = parts == [token]
        return known

    def _learn(self, pieces: list[str]) -> None:
        """Fills `steps` for sorted pieces; what a piece shares with the one before is not done again."""
        base, apart, endings = self.base, self.apart, self.endings
        before, last, count = b"", [-1], [0]
        for piece in pieces:
            data = piece.encode()
            same = 0
            for x, y in zip(before, data):
                if x != y:
                    break
                same += 1
            del last[same + 1 :], count[same + 1 :]
            for end in range(same + 1, len(data) + 1):
                node, at, fitting = endings, end, []
                while at:
                    node = node.get(data[at - 1])
                    if node is None:
                        break
                    at -= 1
                    token = node.get(-1)
                    if token is not None:
                        fitting.append((token, at))
                for token, at in reversed(fitting):
                    if at:
                        pair = last[at] * base + token
                        fits = apart.get(pair)
                        if fits is None:
                            if len(apart) >= CACHED_PAIRS:
                                apart.clear()
                            fits = apart[pair] = self._stay_apart(last[at], token) and self._merges_to_itself(
                                token, data[at:end]
                            )
                    else:
                        fits = self._merges_to_itself(token, data[:end])
                    if fits:
                        last.append(token)
                        count.append(count[at] + 1)
                        break
            before = data
            counts = count
            if len(data) > len(piece):
                counts = [c for c, byte in zip(count, data + b"a") if byte & 0xC0 != 0x80]
            elif piece in ("'re", "'ve", "'ll"):  # one letter after the mark does not make a contraction yet
                counts = [0, 1, 2, count[3]]
            self.steps[piece] = array("h", map(sub, counts[1:], counts)).tobytes()

    def _steps_of(self, pieces: list[str]) -> list[bytes]:
        if len(self.steps) >= CACHED_PIECES:
            self.older, self.steps = self.steps, {}
        known, older = self.steps, self.older
        unknown = set(pieces).difference(known)
        if unknown:
            known.update((piece, older[piece]) for piece in unknown if piece in older)
            unknown = {piece for piece in unknown if piece not in older}
            self._learn(sorted(unknown))
        found = list(map(known.__getitem__, pieces))
        for piece in unknown:
            if len(piece) > LONG_PIECE:
                del known[piece]
        return found

    def _ordinary_steps(self, text: str, pieces: list[str] | None = None) -> np.ndarray:
        steps = np.frombuffer(b"".join(self._steps_of(self.splitter.pieces(text) if pieces is None else pieces)), STEP)
        runs = list(SPACES.finditer(text))
        if runs:
            # A run of blanks is cut before its last one, unless the prefix ends with the run.
            steps = steps.copy()
            for run in runs:
                blanks = run.group()
                whole, cut = self._total(blanks), self._total(blanks[:-1]) + self._total(blanks[-1])
                steps[run.end() - 1] += whole - cut
                steps[run.end()] -= whole - cut
        return steps

    def _total(self, piece: str) -> int:
        return int(np.frombuffer(self._steps_of([piece])[0], STEP).sum())

    def prefix_steps(self, text: str) -> np.ndarray:
        """For each character, by how much it changes the token count of the text up to it."""
        parts = self.splitter.parts(text)
        if len(parts) == 1:
            return self._ordinary_steps(text)
        found = []
        for ordinary, special in parts:
            if special is None:
                found.append(self._ordinary_steps(ordinary))
                continue
            open_steps = self._ordinary_steps(ordinary + special[:-1])
            closed = int(self._ordinary_steps(ordinary).sum(dtype=np.int64)) + 1
            found.append(np.append(open_steps, STEP.type(closed - int(open_steps.sum(dtype=np.int64)))))
        return np.concatenate(found)

    def prefix_steps_of(self, texts: list[str]) -> Iterator[np.ndarray]:
        """`prefix_steps` of each text; stretches of texts learn their new pieces together."""
        at = 0
        while at < len(texts):
            end, size = at, 0
            while end < len(texts) and size < TOGETHER:
                size += len(texts[end])
                end += 1
            parts = [self.splitter.parts(text) for text in texts[at:end]]
            pieces = [self.splitter.pieces(p[0][0]) if len(p) == 1 else None for p in parts]
            if len(self.steps) < CACHED_PIECES:
                new = {piece for found in pieces if found for piece in found}
                new = new.difference(self.steps).difference(self.older)
                self._learn(sorted(piece for piece in new if len(piece) <= LONG_PIECE))
            for text, found in zip(texts[at:end], pieces, strict=True):
                yield self.prefix_steps(text) if found is None else self._ordinary_steps(text, found)
            at = end


@cache
def _counter(source: str) -> PrefixCounter:
    return PrefixCounter(source)


def longest_prefix(steps: np.ndarray, limit: int) -> int:
    """Characters in the longest prefix of at most `limit` tokens; counts may fall as a text grows."""
    within = np.flatnonzero(np.cumsum(steps, dtype=np.int64) <= limit)
    return int(within[-1]) + 1 if len(within) else 0


def _shared_counter(df: DataFrame, path: str):
    source = df.sparkSession.sparkContext.broadcast(read_file(path))
    return lambda: _counter(source.value)


def token_counts(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """One row per row of `docs`: `doc_id`, `n_bytes`, `n_tokens`, `over_limit`, `fits_chars`.

    `fits_chars` is the number of characters in the longest prefix of at most
    `limit` tokens. A null text counts as empty: no bytes, no tokens. Rows repeat
    as they do in `docs`; other columns are not read. Texts of any length are
    counted whole, with two bytes a character held for one text at a time. An
    empty table gives no rows.
    """
    counter_of = _shared_counter(docs, path)

    def make():
        counter = counter_of()

        def count(batch: pa.RecordBatch) -> dict:
            out = {"doc_id": batch.column("doc_id"), "n_bytes": [], "n_tokens": [], "over_limit": [], "fits_chars": []}
            whole = texts(batch)
            for text, steps in zip(whole, counter.prefix_steps_of(whole), strict=True):
                total = int(steps.sum(dtype=np.int64))
                out["n_bytes"].append(len(text.encode()))
                out["n_tokens"].append(total)
                out["over_limit"].append(total > limit)
                out["fits_chars"].append(longest_prefix(steps, limit) if total > limit else len(text))
            return out

        return count

    return map_batches(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"),
        make,
        "doc_id long, n_bytes long, n_tokens long, over_limit boolean, fits_chars long",
    )


def prefix_table(docs: DataFrame, path: str) -> DataFrame:
    """The stored prefix counts: `doc_id`, `from_char`, `before`, `steps`.

    A row covers up to 65,536 characters from `from_char` on: `before` is the
    token count of the text up to there, `steps` the change with each character.
    An empty or null text has one row without steps.
    """
    counter_of = _shared_counter(docs, path)

    def make():
        counter = counter_of()

        def store(batch: pa.RecordBatch) -> dict:
            out: dict = {"doc_id": [], "from_char": [], "before": [], "steps": []}
            for doc_id, steps in zip(batch.column("doc_id").to_pylist(), counter.prefix_steps_of(texts(batch)), strict=True):
                before = 0
                for at in range(0, max(1, len(steps)), PREFIXES_PER_ROW):
                    part = steps[at : at + PREFIXES_PER_ROW]
                    for name, value in (("doc_id", doc_id), ("from_char", at), ("before", before), ("steps", part.tolist())):
                        out[name].append(value)
                    before += int(part.sum(dtype=np.int64))
            return out

        return store

    return map_batches(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"),
        make,
        "doc_id long, from_char long, before long, steps array<short>",
    )


def tokens_in_prefix(table: DataFrame, questions: DataFrame) -> DataFrame:
    """Answers `questions` (`doc_id`, `n_chars`) from a stored table, adding `n_tokens`.

    `n_chars` beyond the text asks for all of it; unknown documents get no row.
    """
    met = table.join(questions.select("doc_id", "n_chars"), "doc_id").where(
        (F.col("n_chars") > F.col("from_char")) | (F.col("from_char") == 0)
    )
    inside = F.slice("steps", 1, F.greatest(F.lit(0), F.col("n_chars") - F.col("from_char")).cast("int"))
    count = F.col("before") + F.aggregate(inside, F.lit(0).cast("long"), lambda total, step: total + step)
    return (
        met.withColumn("n_tokens", count)
        .groupBy("doc_id", "n_chars")
        .agg(F.max_by("n_tokens", "from_char").alias("n_tokens"))
    )


__all__ = ["LATIN_SPACE", "PrefixCounter", "longest_prefix", "prefix_table", "token_counts", "tokens_in_prefix"]
