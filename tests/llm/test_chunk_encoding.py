import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tillhouse.llm import chunk_encoding
from tillhouse.llm.chunk_encoding import chunk_ends, decode_documents, encode_documents

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)


def brute(text, library=LIBRARY):
    ids = library.encode(text or "", add_special_tokens=False).ids
    decoded = library.decode(ids, skip_special_tokens=False)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return len(ids), sha(" ".join(map(str, ids))), sha(decoded)


def shared_texts():
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdeéß中A'1 ") for _ in range(rng.randint(1, 9)))
    passage = " ".join(word() for _ in range(2500))
    unspaced = "".join(rng.choice("abcdef0123é") for _ in range(40000))
    own = [" ".join(word() for _ in range(rng.randint(0, 1500))) for _ in range(25)]
    return [a + passage + b for a, b in zip(own, own[1:])] + [unspaced, "x " + unspaced, passage, passage] + own


def check(rows, texts):
    got = sorted((-1 if r.doc_id is None else r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows)
    assert got == sorted((k, *brute(text)) for k, text in texts)


def test_chunks_follow_the_content():
    data = shared_texts()[0].encode()
    ends = chunk_ends(data)
    assert ends[-1] == len(data) and ends == sorted(set(ends))
    for start, end in zip([0, *ends], ends):
        data[start:end].decode()
    moved = chunk_ends(b"some other beginning " + data)
    assert len({e + 21 for e in ends} & set(moved)) > len(ends) * 0.9


def test_shared_passages_repeated_rows_and_odd_texts(documents, staging, odd_texts):
    texts = shared_texts() + odd_texts
    docs = documents(texts, extra=[(None, texts[0], None, None, None)], repeat=True)
    rows = encode_documents(docs, staging, PATH, digests=True).collect()
    check(rows, 2 * [*enumerate(texts), (-1, texts[0])])


def test_chunks_are_borrowed(documents, staging):
    """The shared passage's ids come from one document only."""
    keyed = chunk_encoding._keyed(documents(shared_texts()))
    uses = [use for row in chunk_encoding._shared_chunks(keyed, staging).collect() for use in row.uses]
    chunks = {(use.high, use.low) for use in uses}
    assert len(uses) > 3 * len(chunks) > 20
    assert sum(use.own for use in uses) == len(chunks)


def test_ids_decode_to_the_text_of_the_library(documents, staging, odd_texts):
    texts = [text for text in odd_texts if text] + shared_texts()[:4]
    encoded = encode_documents(documents(texts), staging, PATH)
    decoded = {r.doc_id: r.text for r in decode_documents(encoded, PATH).collect()}
    for k, text in enumerate(texts):
        ids = LIBRARY.encode(text, add_special_tokens=False).ids
        assert decoded[k] == LIBRARY.decode(ids, skip_special_tokens=False)


def test_vocabularies_whose_pieces_hold_blanks_are_refused(documents, staging):
    with pytest.raises(ValueError):
        encode_documents(documents(["a"]), staging, public_tokenizers.path("byte_bpe_50k.json"))


def test_empty_table(documents, staging):
    assert encode_documents(documents([]), staging, PATH).count() == 0


def test_whole_table(spark, sf_dir, staging):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    check(encode_documents(docs, staging, PATH, digests=True).collect(), [(r.doc_id, r.text) for r in docs.collect()])


def test_the_cache_of_words_stays_bounded(monkeypatch):
    monkeypatch.setattr(chunk_encoding, "CACHE_BYTES", 100_000)
    encoder = chunk_encoding.Encoder(chunk_encoding.read_file(PATH))
    rng = random.Random(1)
    for _ in range(10):
        encoder.encode_all(["".join(rng.choice("acgt") for _ in range(40_000)) for _ in range(5)])
    assert not encoder.known
    for _ in range(30):
        text = " ".join("".join(rng.choice("abcdefgh中é'1.") for _ in range(9)) for _ in range(500))
        assert encoder.encode(text) == np.array(LIBRARY.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        held = [*encoder.known.items(), *encoder.known.older.items()]
        assert sum(chunk_encoding.ENTRY_BYTES + len(w) + len(ids) for w, ids in held) < 210_000
    encoder.known.rest()
    assert not encoder.known.older


@pytest.mark.parametrize("separator", ["\x1c", "\x1f", "\x85", " ", "​", "᠎", "﻿", "　", "\x0b", "\x00"])
def test_white_space_is_what_the_library_takes_for_it(separator):
    encoder = chunk_encoding.Encoder(chunk_encoding.read_file(PATH))
    text = f"two{separator}Words{separator}{separator}'s 1{separator}2 {separator}x."
    assert encoder.encode(text) == np.array(LIBRARY.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def test_ids_move_in_as_few_bytes_as_the_vocabulary_needs():
    from array import array
    from pathlib import Path

    import public_tokenizers

    from tillhouse.llm.chunk_encoding import Encoder

    encoder = Encoder(Path(public_tokenizers.path("word_bpe_49k.json")).read_text())
    ids = array("I", [0, 1, 255, 256, len(encoder.names) - 1]).tobytes()
    assert len(encoder.packed(ids)) == len(ids) // 2
    assert encoder.unpacked(encoder.packed(ids)) == ids
    assert encoder.unpacked(encoder.packed(b"")) == b""
