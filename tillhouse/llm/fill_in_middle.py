"""Fill-in-the-middle transformation by rotating blocks in place.

A text is cut at two line ends into prefix, middle and suffix. Its bytes and three
sentinels are laid out in one bytearray, and two neighbouring blocks are exchanged
by three reversals, so that the suffix comes before the middle (`psm`) or before
everything (`spm`). The inverse finds the sentinels, rotates the same blocks back
and drops the sentinels, which gives the text byte for byte.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillhouse.llm.columns import map_batches

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
SEED = 7
FIM_PERCENT = 100
SPM_PERCENT = 50
SWAPPED_AT_ONCE = 1 << 16
LINE_END = re.compile("\n")


@dataclass(frozen=True)
class Cut:
    """How many units a text has, where its middle begins and ends in code points, and its form."""

    units: int
    form: str
    start: int = 0
    end: int = 0


def draws(doc_id: int | None, seed: int = SEED) -> tuple[int, int, int, int]:
    """Four unsigned 32-bit numbers that depend on the id alone; a missing id counts as an empty one."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return tuple(int.from_bytes(digest[k : k + 4], "big") for k in (0, 4, 8, 12))


def choose_cut(text: str, doc_id: int | None, seed: int = SEED) -> Cut:
    """Cuts between lines, a line being what `[^\\n]*\\n|[^\\n]+` matches."""
    ends = [match.end() for match in LINE_END.finditer(text)]
    if len(text) > (ends[-1] if ends else 0):
        ends.append(len(text))
    units = len(ends)
    first, second, whether, which = draws(doc_id, seed)
    held = any(mark.decode() in text for mark in (PREFIX, SUFFIX, MIDDLE))
    if not text or held or whether % 100 >= FIM_PERCENT:
        return Cut(units, "plain")
    low, high = sorted((first % (units + 1), second % (units + 1)))
    at = [0, *ends]
    return Cut(units, "spm" if which % 100 < SPM_PERCENT else "psm", at[low], at[high])


def reverse(buffer: bytearray, start: int, end: int) -> None:
    """Reverses `buffer[start:end]` where it stands, a block from each end at a time."""
    view = np.frombuffer(buffer, np.uint8)
    while end - start > 1:
        size = min(SWAPPED_AT_ONCE, (end - start) // 2)
        low, high = view[start : start + size], view[end - size : end]
        held = low[::-1].copy()
        low[:] = high[::-1]
        high[:] = held
        start, end = start + size, end - size


def exchange(buffer: bytearray, start: int, middle: int, end: int) -> None:
    """Turns `buffer[start:middle]`, `buffer[middle:end]` into the second followed by the first."""
    reverse(buffer, start, middle)
    reverse(buffer, middle, end)
    reverse(buffer, start, end)


def transform(text: str, cut: Cut) -> bytes:
    """The text in the form of its cut, in UTF-8."""
    if cut.form == "plain":
        return text.encode()
    buffer = bytearray(PREFIX)
    buffer += text[: cut.start].encode()
    middle = len(buffer)
    buffer += MIDDLE + text[cut.start : cut.end].encode()
    suffix = len(buffer)
    buffer += SUFFIX + text[cut.end :].encode()
    exchange(buffer, middle if cut.form == "psm" else 0, suffix, len(buffer))
    return bytes(buffer)


def restore(output: bytes, form: str) -> bytes:
    """The text that `transform` was given, from what it made and the form alone.

    Its texts hold no sentinels of their own, so each is found where it was put.
    """
    if form == "plain":
        return output
    buffer = bytearray(output)
    suffix, middle = buffer.index(SUFFIX), buffer.index(MIDDLE)
    if form == "psm":
        exchange(buffer, suffix, middle, len(buffer))
    else:
        exchange(buffer, 0, buffer.index(PREFIX), len(buffer))
    middle = buffer.index(MIDDLE)
    suffix = buffer.index(SUFFIX, middle)
    del buffer[suffix : suffix + len(SUFFIX)]
    del buffer[middle : middle + len(MIDDLE)]
    del buffer[: len(PREFIX)]
    return bytes(buffer)


def fill_in_middle(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """One row per row of `docs`: `doc_id`, `n`, `form`, `prefix_chars`, `middle_chars`, `output`.

    `n` is the number of lines, `output` the whole transformed text. The form is
    `plain`, with no lengths and the text as it is, for empty texts and for those
    that hold a sentinel; null texts count as empty. A text without line ends is
    one line, however long. Cuts and form depend on `seed`, id and number of
    lines alone, so repeated rows give equal rows; rows without an id share their
    draws. Other columns are not read. An empty table gives no rows.
    """

    def make():
        def turn(batch: pa.RecordBatch) -> dict:
            out: dict = {name: [] for name in ("n", "form", "prefix_chars", "middle_chars", "output")}
            for doc_id, value in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                text = value.as_py() or ""
                cut = choose_cut(text, doc_id, seed)
                plain = cut.form == "plain"
                out["n"].append(cut.units)
                out["form"].append(cut.form)
                out["prefix_chars"].append(None if plain else cut.start)
                out["middle_chars"].append(None if plain else cut.end - cut.start)
                out["output"].append(transform(text, cut).decode())
            return {"doc_id": batch.column("doc_id")} | out

        return turn

    return map_batches(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")),
        make,
        "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string",
    )


def restored(transformed: DataFrame) -> DataFrame:
    """All columns of `transformed`, and `text` as it was, from `output` and `form` alone.

    A column of that name is replaced.
    """
    columns = [f for f in transformed.schema.fields if f.name != "text"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in columns)

    def make():
        def back(batch: pa.RecordBatch) -> dict:
            texts = [
                restore(output.as_py().encode(), form.as_py()).decode()
                for output, form in zip(batch.column("output"), batch.column("form"), strict=True)
            ]
            return {f.name: batch.column(f.name) for f in columns} | {"text": texts}

        return back

    return map_batches(transformed, make, f"{schema}, text string")


def digest(transformed: DataFrame) -> DataFrame:
    """The table of `fill_in_middle` with hashes of the outputs and of the texts restored from them."""
    sha = {name: F.sha2(F.col(name).cast("binary"), 256) for name in ("output", "text")}
    return restored(transformed).select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        sha["output"].alias("output_sha256"),
        sha["text"].alias("restored_sha256"),
    )
