import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tillhouse.llm import packing
from tillhouse.llm.packing import TightestRoom, pack_documents, plan, sequences

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)


def ids_of(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids + [1]


def best_fit(lengths, capacity):
    """Room left in each sequence, piece by piece."""
    rooms = []
    for length in sorted(lengths, reverse=True):
        fitting = [k for k, room in enumerate(rooms) if room >= length]
        if not fitting:
            rooms.append(capacity)
            fitting = [len(rooms) - 1]
        tightest = min(fitting, key=lambda k: rooms[k])
        rooms[tightest] -= length
    return sorted(rooms)


def check_placed(placed, capacity):
    """Every sequence is filled from 0 without gaps; returns the room left in each."""
    by_sequence = defaultdict(list)
    for length, sequence, offset in placed:
        by_sequence[sequence].append((offset, length))
    left = []
    for pieces in by_sequence.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
        assert end <= capacity
        left.append(capacity - end)
    return sorted(left)


@settings(max_examples=300, deadline=None)
@given(st.integers(1, 40).flatmap(lambda c: st.tuples(st.just(c), st.lists(st.integers(1, c), max_size=120))))
def test_the_plan_is_best_fit_decreasing_piece_by_piece(drawn):
    capacity, lengths = drawn
    packed = plan(Counter(lengths), capacity)
    numbers, met = [], Counter()
    for length in lengths:
        numbers.append(met[length])
        met[length] += 1
    sequence, offset = packed.place(np.array(lengths, np.int64), np.array(numbers, np.int64))
    left = check_placed(zip(lengths, sequence.tolist(), offset.tolist()), capacity)
    assert left == best_fit(lengths, capacity)
    assert packed.sequences == len(left)


@given(st.sets(st.integers(0, 33)), st.integers(0, 33))
def test_the_tree_finds_the_tightest_room(rooms, wanted):
    tree = TightestRoom(33)
    for room in rooms:
        tree.set(room, True)
    assert tree.at_least(wanted) == min((r for r in rooms if r >= wanted), default=None)
    for room in rooms:
        tree.set(room, False)
    assert tree.at_least(wanted) is None


def test_moves_do_not_grow_with_the_pieces():
    rng = random.Random(3)
    few = {length: rng.randint(1, 50) for length in range(1, 4097)}
    many = {length: n * 10**9 for length, n in few.items()}
    assert len(plan(many).moves["length"]) < 2 * len(plan(few).moves["length"]) < 200_000
    with pytest.raises(ValueError):
        plan({4097: 1})


def test_pieces_of_odd_long_and_repeated_texts(documents, staging, odd_texts):
    texts = [*odd_texts, "word " * 4095, "word " * 4096, "a b c " * 5000, *["same text"] * 30]
    docs = documents(texts, extra=[(None, "no id", None, None, None)], repeat=True)
    clashing = docs.selectExpr("*", "1 AS sequence_id", "2 AS offset", "3 AS part", "4 AS ids", "5 AS length")
    rows = pack_documents(clashing, staging, PATH).collect()
    expected = []
    for doc_id, text in [*enumerate(texts), (None, "no id")]:
        ids = ids_of(text)
        for piece, at in enumerate(range(0, len(ids), 4096)):
            held = np.array(ids[at : at + 4096], "<u4").tobytes()
            expected += 2 * [(doc_id, piece, at, len(held) // 4, zlib.crc32(held), held)]
    got = [(r.doc_id, r.piece, r.start, r.length, r.ids_crc32, bytes(r.ids)) for r in rows]
    assert Counter(got) == Counter(expected)
    left = check_placed([(r.length, r.sequence_id, r.offset) for r in rows], 4096)
    assert left == best_fit([r.length for r in rows], 4096)


def test_sequences_hold_their_pieces_in_order(documents, staging):
    texts = ["one two three", None, "four", "five six seven eight"]
    packed = staging.save(pack_documents(documents(texts), staging, PATH, capacity=8), "packed")
    whole = {r.sequence_id: r for r in sequences(packed).collect()}
    for r in packed.collect():
        held = np.frombuffer(bytes(whole[r.sequence_id].ids), "<u4")
        assert held[r.offset : r.offset + r.length].tobytes() == bytes(r.ids)
        assert r.doc_id in whole[r.sequence_id].doc_ids
    assert sum(r.n_tokens for r in whole.values()) == sum(len(ids_of(t)) for t in texts)


def test_an_empty_table_gives_no_rows(documents, staging):
    rows = pack_documents(documents([]), staging, PATH, keep_ids=False)
    assert rows.count() == 0 and "ids" not in rows.columns


def test_the_query_packs_the_whole_table(spark, sf_dir):
    from tillhouse.llm import queries

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    rows = queries.op11_best_fit_packing(spark, sf_dir).collect()
    assert Counter((r.doc_id, r.length) for r in rows if r.piece == 0) == Counter(
        (d.doc_id, min(4096, len(ids_of(d.text)))) for d in docs
    )
    left = check_placed([(r.length, r.sequence_id, r.offset) for r in rows], packing.CAPACITY)
    assert left == best_fit([r.length for r in rows], packing.CAPACITY)
