"""BPE encoding and decoding with content-defined chunk reuse.

A rolling hash cuts every text into chunks whose borders depend on nothing but
the bytes around them, so that copies and shared passages give equal chunks
wherever they stand. A chunk met more than once is encoded once, by the first
document that has it, and its ids are joined back to the others.

Only the middle of a chunk is reused, from its first to its last anchor. An
anchor is a blank or line end: neither normalisation nor the split into pieces
looks across one, so ids on both of its sides are independent. What lies between
the last anchor of one chunk and the first of the next is the join. Each join is
encoded again as one stretch, which grows until both its ends rest on anchors;
from there on the ids agree with those of the whole text.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillhouse.llm.columns import map_batches, row_key, sliced, texts
from tillhouse.llm.vocabulary import Splitter, byte_alphabet, read_file
from tillhouse.staging import Staging

WINDOW = 16
MASK = (1 << 10) - 1
LEAST, MOST = 256, 8192
CACHE_BYTES = 48 << 20
ENTRY_BYTES = 200
LONG_PIECE = 64
ID, SHORT_ID = np.dtype("<u4"), np.dtype("<u2")
ANCHOR = re.compile("[ \n]")
GEAR = np.random.default_rng(7).integers(0, 1 << 32, 256, dtype=np.uint32)


def chunk_ends(data: bytes) -> list[int]:
    """Where the chunks of a UTF-8 text end; the last end is its length."""
    n = len(data)
    if n <= LEAST:
        return [n] if n else []
    raw = np.frombuffer(data, np.uint8)
    rolling = GEAR[raw]
    step = 1
    while step < WINDOW:
        shifted = rolling[:-step] << np.uint32(step)
        rolling = rolling.copy()
        rolling[step:] += shifted
        step *= 2
    # The low bits hold only the last few bytes; the upper ones see the window.
    hits = np.flatnonzero((rolling >> np.uint32(12)) & np.uint32(MASK) == 0) + 1
    ends, start = [], 0
    for hit in [*hits.tolist(), n]:
        while hit - start > MOST:
            cut = start + MOST
            while data[cut] & 0xC0 == 0x80:
                cut -= 1
            ends.append(cut)
            start = cut
        if hit == n or (hit - start >= LEAST and data[hit] & 0xC0 != 0x80):
            ends.append(hit)
            start = hit
    return ends


def middle_of(chunk: str) -> tuple[int, int]:
    """Start and end of what lies between the first and the last anchor of a chunk; empty without two."""
    first = ANCHOR.search(chunk)
    if first is None:
        return 0, 0
    return first.start(), max(chunk.rfind(" "), chunk.rfind("\n"))


class KnownWords(dict):
    """The ids of words met so far, worked out on the first look-up, within `CACHE_BYTES` a generation.

    Of a full cache only what is asked for again stays; words over `LONG_PIECE` characters never do.
    """

    def __init__(self, learn: Callable[[str], bytes]):
        super().__init__()
        self.learn = learn
        self.older: dict[str, bytes] = {}
        self.size = 0

    def __missing__(self, word: str) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            ids = self.learn(word)
        if len(word) <= LONG_PIECE:
            if self.size > CACHE_BYTES:
                self.older, self.size = dict(self), 0
                self.clear()
            self[word] = ids
            self.size += ENTRY_BYTES + len(word) + len(ids)
        return ids

    def rest(self) -> None:
        """Lets go of the older generation, for workers that stay idle between tasks."""
        self.older = {}


class Encoder:
    """Ids of texts as the tokenizers library gives them, from a bounded cache of words."""

    def __init__(self, source: str):
        self.splitter = Splitter(source)
        library = self.splitter.library
        self.merge = library.model.tokenize
        self.known = KnownWords(self._ids_of)
        size = library.get_vocab_size(with_added_tokens=True)
        self.moved = SHORT_ID if size <= 1 << 16 else ID
        self.joins_tokens = json.loads(source)["decoder"] is None
        self.names = [library.id_to_token(k) or "" for k in range(size)]
        self.numerals = [str(k) for k in range(size)]
        self.printable = {byte: shown for shown, byte in byte_alphabet().items()}

    def _ids_of(self, word: str) -> bytes:
        """The ids of one normalized word: those of its pieces, whose bytes are merged as printable characters."""
        pieces = [word] if word.isascii() and word.isalpha() else self.splitter.cut(word)
        if len(pieces) > 1:
            return b"".join(map(self.known.__getitem__, pieces))
        shown = word if word.isascii() and word.isprintable() else word.encode().decode("latin-1").translate(self.printable)
        return array("I", [token.id for token in self.merge(shown)]).tobytes()

    def encode(self, text: str) -> bytes:
        """The ids of one text, four bytes each."""
        parts = self.splitter.parts(text)
        if len(parts) == 1:
            return b"".join(map(self.known.__getitem__, self.splitter.words(text)))
        found = []
        for ordinary, special in parts:
            found.extend(map(self.known.__getitem__, self.splitter.words(ordinary)))
            if special is not None:
                found.append(np.array([self.splitter.specials[special]], ID).tobytes())
        return b"".join(found)

    def encode_all(self, stretches: list[str]) -> list[bytes]:
        """The ids of each stretch, four bytes each."""
        return [self.encode(stretch) for stretch in stretches]

    def packed(self, ids: bytes) -> bytes:
        """The ids in as few bytes as the vocabulary needs, for the way to other rows."""
        return np.frombuffer(ids, ID).astype(self.moved).tobytes()

    def unpacked(self, moved: bytes) -> bytes:
        return np.frombuffer(moved, self.moved).astype(ID).tobytes()

    def decode(self, ids: list[int]) -> str:
        if self.joins_tokens:
            return " ".join(map(self.names.__getitem__, ids))
        return self.splitter.library.decode(ids, skip_special_tokens=False)

    def digests(self, ids: bytes) -> tuple[int, str, str]:
        """Number of ids, the hash of the ids as text, and the hash of the decoded text."""
        numbers = np.frombuffer(ids, ID).tolist()
        listed = " ".join(map(self.numerals.__getitem__, numbers))
        return (
            len(numbers),
            hashlib.sha256(listed.encode()).hexdigest(),
            hashlib.sha256(self.decode(numbers).encode()).hexdigest(),
        )


@cache
def _encoder(source: str) -> Encoder:
    return Encoder(source)


def _shared_source(df: DataFrame, path: str):
    source = read_file(path)
    if json.loads(source)["normalizer"] is None:
        raise ValueError(f"the pieces of {path} hold blanks, so blanks are no anchors there")
    return df.sparkSession.sparkContext.broadcast(source)


def _keyed(docs: DataFrame) -> DataFrame:
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return plain.select("doc_id", "text", row_key()["id"].alias("id"), row_key()["digest"].alias("digest"))


def chunk_refs(docs: DataFrame) -> DataFrame:
    """Every reusable chunk of every row: row key, place in the text and a 128-bit hash of its bytes."""

    def make():
        def cut(batch: pa.RecordBatch) -> dict:
            rows: dict = {"id": [], "digest": [], "place": [], "high": [], "low": []}
            for key, digest, text in zip(
                batch.column("id").to_pylist(), batch.column("digest").to_pylist(), texts(batch), strict=True
            ):
                data, start = text.encode(), 0
                for place, end in enumerate(chunk_ends(data)):
                    chunk = data[start:end]
                    first = min((at for at in (chunk.find(b" "), chunk.find(b"\n")) if at >= 0), default=len(chunk))
                    if max(chunk.rfind(b" "), chunk.rfind(b"\n")) - first > LEAST // 4:
                        value = xxhash.xxh3_128_digest(chunk)
                        rows["id"].append(key)
                        rows["digest"].append(digest)
                        rows["place"].append(place)
                        rows["high"].append(int.from_bytes(value[:8], "big", signed=True))
                        rows["low"].append(int.from_bytes(value[8:], "big", signed=True))
                    start = end
            return rows

        return cut

    return map_batches(docs.select("id", "digest", "text"), make, "id long, digest long, place int, high long, low long")


def _shared_chunks(docs: DataFrame, staging: Staging) -> DataFrame:
    """For each row key with chunks that occur more than once: where they are, and which ones it encodes for all."""
    refs = staging.save(chunk_refs(docs), "refs")
    chunk = ["high", "low"]
    met = (
        refs.groupBy(*chunk)
        .agg(F.count("*").alias("times"), F.min(F.struct("id", "digest", "place")).alias("first"))
        .where("times > 1")
        .drop("times")
    )
    # Written, so that the join deals both sides anew and adaptive execution can split a chunk that very many rows have.
    places = refs.join(staging.save(met, "met"), chunk).select(
        "id",
        "digest",
        F.struct("place", *chunk, (F.struct("id", "digest", "place") == F.col("first")).alias("own")).alias("use"),
    )
    return places.groupBy("id", "digest").agg(F.collect_set("use").alias("uses"))


PART = "doc_id long, own boolean, high long, low long, ids binary, parts array<binary>, n_tokens long, ids_sha256 string, decoded_sha256 string, holes array<struct<high:bigint,low:bigint>>"


def _cut_rows(source, digests: bool):
    """Encodes what each row has to encode itself.

    A row without borrowed chunks gives its result; any other gives the ids
    around its holes, packed. A row that owns shared chunks gives those as well.
    """
    arrow_schema = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("own", pa.bool_()),
            ("high", pa.int64()),
            ("low", pa.int64()),
            ("ids", pa.binary()),
            ("parts", pa.list_(pa.binary())),
            ("n_tokens", pa.int64()),
            ("ids_sha256", pa.string()),
            ("decoded_sha256", pa.string()),
            ("holes", pa.list_(pa.struct([("high", pa.int64()), ("low", pa.int64())]))),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(source.value)
        for batch in sliced(batches):
            rows: list[dict] = []
            stretches: list[str] = []
            plans: list[tuple] = []
            for doc_id, text, uses in zip(
                batch.column("doc_id").to_pylist(), texts(batch), batch.column("uses").to_pylist(), strict=True
            ):
                if not uses:
                    plans.append((doc_id, [], len(stretches), len(stretches) + 1, ()))
                    stretches.append(text)
                    continue
                by_place = {use["place"]: use for use in uses}
                data, start, open_at = text.encode(), 0, 0
                holes, owned, first = [], [], len(stretches)
                for place, end in enumerate(chunk_ends(data)):
                    use = by_place.get(place)
                    if use is not None:
                        chunk = data[start:end].decode()
                        a, b = (len(chunk[:k].encode()) + start for k in middle_of(chunk))
                        stretches.append(data[open_at:a].decode())
                        if use["own"]:
                            owned.append((len(stretches), use["high"], use["low"]))
                            stretches.append(data[a:b].decode())
                        else:
                            holes.append({"high": use["high"], "low": use["low"]})
                            stretches.append(None)
                        open_at = b
                    start = end
                stretches.append(data[open_at:].decode())
                plans.append((doc_id, holes, first, len(stretches), owned))
            places = [k for k, stretch in enumerate(stretches) if stretch is not None]
            encoded: list[bytes | None] = [None] * len(stretches)
            for k, ids in zip(places, encoder.encode_all([stretches[k] for k in places]), strict=True):
                encoded[k] = ids
            for doc_id, holes, first, end, owned in plans:
                for k, high, low in owned:
                    rows.append({"own": True, "high": high, "low": low, "ids": encoder.packed(encoded[k])})
                if holes:
                    parts = [b""]
                    for k in range(first, end):
                        if encoded[k] is None:
                            parts.append(b"")
                        else:
                            parts[-1] += encoded[k]
                    packed = [encoder.packed(part) for part in parts]
                    rows.append({"doc_id": doc_id, "own": False, "parts": packed, "holes": holes})
                else:
                    rows.append({"doc_id": doc_id, "own": False} | _result(encoder, b"".join(encoded[first:end]), digests))
            for at in range(0, len(rows), 2000):
                yield pa.RecordBatch.from_pylist(rows[at : at + 2000], schema=arrow_schema)
        encoder.known.rest()

    return run


def _result(encoder: Encoder, ids: bytes, digests: bool) -> dict:
    if not digests:
        return {"ids": ids, "n_tokens": len(ids) // ID.itemsize}
    n_tokens, ids_sha256, decoded_sha256 = encoder.digests(ids)
    return {"n_tokens": n_tokens, "ids_sha256": ids_sha256, "decoded_sha256": decoded_sha256}


def _filled(holed: DataFrame, owned: DataFrame, source, digests: bool) -> DataFrame:
    """Fills the holes of the rows that borrow chunks; a chunk that very many rows borrow is a skewed join side."""
    numbered = holed.withColumn("row", F.monotonically_increasing_id())
    borrowed = (
        numbered.select("row", F.posexplode("holes").alias("place", "hole"))
        .select("row", "place", "hole.*")
        .join(owned, ["high", "low"])
        .groupBy("row")
        .agg(F.sort_array(F.collect_list(F.struct("place", "ids"))).alias("borrowed"))
    )
    whole = numbered.select("row", "doc_id", "parts").join(borrowed, "row")

    def make():
        encoder = _encoder(source.value)

        def fill(batch: pa.RecordBatch) -> dict:
            out: dict = {"doc_id": batch.column("doc_id"), "ids": [], "n_tokens": [], "ids_sha256": [], "decoded_sha256": []}
            for parts, middles in zip(
                batch.column("parts").to_pylist(), batch.column("borrowed").to_pylist(), strict=True
            ):
                pieces = [parts[0]]
                for middle, part in zip(middles, parts[1:], strict=True):
                    pieces += [middle["ids"], part]
                result = _result(encoder, encoder.unpacked(b"".join(pieces)), digests)
                for name in ("ids", "n_tokens", "ids_sha256", "decoded_sha256"):
                    out[name].append(result.get(name))
            return out

        return fill

    return map_batches(
        whole, make, "doc_id long, ids binary, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )


def encode_documents(docs: DataFrame, staging: Staging, path: str, digests: bool = False) -> DataFrame:
    """One row per row of `docs`, with its token ids.

    By default `doc_id`, `n_tokens` and `ids` (four bytes each, see `decode_documents`);
    with `digests`, `doc_id`, `n_tokens`, `ids_sha256` and `decoded_sha256` instead, so that
    long id lists need not be moved. Null texts count as empty and have no ids. Repeated
    rows each give a row; other columns are not read; an empty table gives no rows.
    Ids do not depend on which of several copies of a chunk is encoded. Texts are
    encoded whole, however long; words over `LONG_PIECE` are not kept.
    """
    source = _shared_source(docs, path)
    keyed = _keyed(docs)
    uses = staging.save(_shared_chunks(keyed, staging), "uses")
    # Chunks may be shared by most rows: the plan is that of large inputs on small ones as well.
    cut = keyed.join(uses.hint("merge"), ["id", "digest"], "left").select("doc_id", "text", "uses")
    cut = staging.save(cut.mapInArrow(_cut_rows(source, digests), PART), "cut")
    owned = cut.where("own").select("high", "low", "ids").dropDuplicates(["high", "low"])
    results = ["doc_id", "ids", "n_tokens", "ids_sha256", "decoded_sha256"]
    whole = cut.where("NOT own AND holes IS NULL").select(*results)
    holed = cut.where("NOT own AND holes IS NOT NULL").select("doc_id", "parts", "holes")
    every = whole.union(_filled(holed, owned, source, digests).select(*results))
    return every.drop("ids") if digests else every.select("doc_id", "n_tokens", "ids")


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """`doc_id` and the `text` that the ids of `encode_documents` decode to, special tokens included."""
    source = _shared_source(encoded, path)

    def make():
        encoder = _encoder(source.value)
        return lambda batch: {
            "doc_id": batch.column("doc_id"),
            "text": [encoder.decode(np.frombuffer(ids, ID).tolist()) for ids in batch.column("ids").to_pylist()],
        }

    return map_batches(encoded.select("doc_id", "ids"), make, "doc_id long, text string")
