import hashlib
import re
from collections import Counter

import pytest
from compare import differences, oracle_connection
from hypothesis import given, settings
from hypothesis import strategies as st

from tillhouse.llm import queries
from tillhouse.llm.fill_in_middle import (
    Cut,
    choose_cut,
    digest,
    exchange,
    fill_in_middle,
    restore,
    restored,
    reverse,
    transform,
)
from tillhouse.llm.oracles import FILL_IN_MIDDLE

PIECES = st.sampled_from(["a", "\n", "\r\n", "é", "中", "\U0001f600", " ", "<", "P>", "<S", ">", "\x00", "word"])
TEXTS = st.lists(PIECES, max_size=30).map("".join)


def brute(text, doc_id):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(units)
    h = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k : 8 * k + 8], 16) for k in range(4))
    if not text or any(mark in text for mark in ("<P>", "<S>", "<M>")) or h3 % 100 >= 100:
        return n, "plain", None, None, text
    low, high = sorted([h1 % (n + 1), h2 % (n + 1)])
    p, m, s = "".join(units[:low]), "".join(units[low:high]), "".join(units[high:])
    if h4 % 100 < 50:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@settings(max_examples=300)
@given(TEXTS, st.integers(-5, 2000))
def test_transformation_and_its_inverse(text, doc_id):
    cut = choose_cut(text, doc_id)
    n, form, prefix, middle, output = brute(text, doc_id)
    assert (cut.units, cut.form) == (n, form)
    if form != "plain":
        assert (cut.start, cut.end - cut.start) == (prefix, middle)
    made = transform(text, cut)
    assert made.decode() == output
    assert restore(made, form).decode() == text


@given(st.binary(max_size=60), st.data())
def test_three_reversals_exchange_two_blocks(data, draw):
    a, b, c = sorted(draw.draw(st.integers(0, len(data))) for _ in range(3))
    buffer = bytearray(data)
    exchange(buffer, a, b, c)
    assert bytes(buffer) == data[:a] + data[b:c] + data[a:b] + data[c:]


def test_long_blocks_are_reversed_in_parts():
    data = bytes(range(251)) * 3001
    buffer = bytearray(data)
    reverse(buffer, 5, len(data) - 2)
    assert bytes(buffer) == data[:5] + data[5:-2][::-1] + data[-2:]


@pytest.mark.parametrize("form", ["psm", "spm"])
def test_every_pair_of_cuts(form):
    text = "one\ntwo é\n\nlast"
    for low in range(len(text) + 1):
        for high in range(low, len(text) + 1):
            made = transform(text, Cut(4, form, low, high))
            assert restore(made, form).decode() == text


def test_odd_repeated_and_nameless_rows(documents, odd_texts):
    texts = [*odd_texts, "a <P> b\n" * 3, "long line " * 200_000, "line\n" * 100_000, "\n", "x\r\ny"]
    docs = documents(texts, extra=[(None, "a\nb\n", None, None, None)], repeat=True)
    clashing = docs.selectExpr("*", "'z' AS output", "1 AS n", "'q' AS form")
    rows = digest(fill_in_middle(clashing)).collect()
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    expected = []
    for doc_id, text in [*enumerate(texts), (None, "a\nb\n")]:
        *told, output = brute(text, doc_id)
        expected += 2 * [(doc_id, *told, sha(output), sha(text or ""))]
    assert Counter(tuple(r) for r in rows) == Counter(expected)


def test_other_columns_are_carried_back_to_the_text(documents):
    docs = documents(["a\nb\nc", None])
    made = fill_in_middle(docs).selectExpr("*", "array(doc_id) AS more", "'old' AS text")
    assert [(r.text, r.more) for r in restored(made).orderBy("doc_id").collect()] == [("a\nb\nc", [0]), ("", [1])]


def test_an_empty_table_gives_no_rows(documents):
    assert digest(fill_in_middle(documents([]))).count() == 0


def test_the_query_agrees_with_sql(spark, sf_dir):
    assert differences(queries.op13_fill_in_middle(spark, sf_dir), oracle_connection(sf_dir), FILL_IN_MIDDLE) is None
