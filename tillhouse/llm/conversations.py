"""Repair of conversation structure by a rank-convergent parallel Viterbi.

The roles of a repaired conversation read `(s?(ua)+)?`: nothing, or turns of user and
assistant after at most one system message. The cheapest edits that reach this are
a shortest path through four states (what may come next) over the rows, found from
the last row back: a vector holds the cost from each state to the end.

All rows of all conversations, in order, are dealt into chunks of `CHUNK_ROWS`, so
that a conversation of any length is many tasks' work. A chunk starts from a
speculative vector, that of a conversation's end, and gives the vector at its
first row. Where a conversation runs on into the next chunk, that chunk's vector is
then the true start, and fix-up passes run such chunks again, from the end until the
new vector differs from the old one by a constant only; from there on every choice
is the same. Passes end when no chunk starts from a vector other than its
neighbour's. Only chunks that lie wholly in one conversation can take more than one.
Rows that all repairs treat alike, as thousands of copies in one conversation, never
make vectors converge: chunks still wrong after `FIXUPS` passes are joined up by
their transfer costs between all states, whose reach doubles with each pass.

The backward costs, so stitched, drive the tracing: from the first row on, the least
letter of those edits that keep to the cheapest cost. The state in which a chunk is
entered is stitched alike; mostly all four states leave a chunk in the same one.

What is the same but for a constant is one vector here: vectors are kept less their
first component, of which few exist, and steps between them are remembered.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillhouse.llm.columns import map_batches
from tillhouse.operators.ranking import dense_key
from tillhouse.staging import Staging

CHUNK_ROWS = 4096
FIXUPS = 4
RENAME, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
WHITE = " \t\n\x0b\x0c\r"

# States: nothing yet, after the system message, after a user, after an assistant.
START, SYSTEM, USER, DONE = range(4)
NEXT = {START: USER, SYSTEM: USER, USER: DONE, DONE: USER}
ROLE = {START: "user", SYSTEM: "user", USER: "assistant", DONE: "user"}
# Codes of rows: the initial of the role, or 0, twice; plus one if truncated. 8 must be deleted.
INITIALS = ("", "u", "a", "s")
DELETED = 8


def kept_state(state: int, code: int) -> int | None:
    """The state after keeping a row as it is, None where its role may not come next."""
    initial = INITIALS[code // 2]
    if initial == "s":
        return SYSTEM if state == START else None
    return NEXT[state] if initial == ROLE[state][0] else None


def with_inserts(vector: list[int]) -> tuple[int, ...]:
    """The costs when messages may be inserted first; three in a row are never worth their cost."""
    for _ in range(3):
        vector = [min(cost, INSERT + vector[NEXT[state]]) for state, cost in enumerate(vector)]
    return tuple(vector)


NEVER = 10**6
END = with_inserts([0, NEVER, NEVER, 0])


def own_edits(state: int, code: int) -> list[tuple[int, str, int]]:
    """What can be done with a row: cost, letter and the state after it."""
    found = [(DELETE, "D", state)]
    if code != DELETED:
        more = TRUNCATED if code % 2 else 0
        found.append((RENAME + more, "R", NEXT[state]))
        kept = kept_state(state, code)
        if kept is not None:
            found.append((more, "K", kept))
    return found


def costs_before(vector: tuple | list, code: int) -> tuple[int, ...]:
    """The costs before a row, given those after it."""
    return with_inserts([min(cost + vector[to] for cost, _, to in own_edits(state, code)) for state in range(4)])


class Costs:
    """Steps of the backward recursion on vectors less their first component, remembered."""

    def __init__(self):
        self.steps: dict[tuple, tuple] = {}

    def before(self, vector: tuple, code: int) -> tuple:
        """The vector before a row, given that after it."""
        if code == DELETED:
            return vector
        found = self.steps.get((vector, code))
        if found is None:
            costs = costs_before(vector, code)
            found = self.steps[vector, code] = tuple(cost - costs[0] for cost in costs)
        return found

    def back(self, codes: bytes, vector: tuple) -> list[tuple]:
        """The vectors before each row and, last, that after them all."""
        found = [vector]
        for code in reversed(codes):
            vector = self.before(vector, code)
            found.append(vector)
        found.reverse()
        return found

    def rerun(self, codes: bytes, vector: tuple, old: tuple, first: tuple) -> tuple:
        """The vector before the first row from a new one after the last, given what an old one led to.

        Stops where the two differ by a constant only.
        """
        for code in reversed(codes):
            if vector == old:
                return first
            vector, old = self.before(vector, code), self.before(old, code)
        return vector


def transfer(codes: bytes) -> list[int]:
    """The costs from each state before the rows to each state after them, less a constant, row by row."""
    columns = []
    for to in range(4):
        costs: tuple | list = [0 if state == to else NEVER for state in range(4)]
        for code in reversed(codes):
            if code != DELETED:
                costs = costs_before(costs, code)
        columns.append(costs)
    least = min(map(min, columns))
    return [min(columns[to][state] - least, NEVER) for state in range(4) for to in range(4)]


def least_edit(state: int, code: int | None, here: tuple, after: tuple | None) -> tuple[str, int]:
    """The least letter among the cheapest edits, and the state that it leads to.

    `here` and `after` are the costs before and after the row, each less a
    constant. Without a row, what is missing is inserted.
    """
    insert = ("I", NEXT[state])
    if code is None:
        return insert
    options = [(cost + after[to], letter, to) for cost, letter, to in own_edits(state, code)]
    if code != DELETED:
        options.append((INSERT + here[NEXT[state]] + _shift(code, here, after), *insert))
    least = min(cost for cost, _, _ in options)
    return min((letter, to) for cost, letter, to in options if cost == least)


def _shift(code: int, here: tuple, after: tuple) -> int:
    """What to add to `here` so that both vectors count from the same zero.

    From some state no insert comes first; there the row's own edits are the cost.
    """
    for state in range(4):
        if here[state] < INSERT + here[NEXT[state]]:
            return min(cost + after[to] for cost, _, to in own_edits(state, code)) - here[state]
    raise AssertionError("the state with the least cost needs no insert")


class Tracer:
    """Edits of a row by state, code and costs, remembered."""

    def __init__(self):
        self.known: dict[tuple, tuple[str, int]] = {}

    def edits(self, state: int, code: int | None, here: tuple, after: tuple | None) -> tuple[str, int]:
        """The letters from `state` up to and with the row's own, or those at a conversation's end."""
        key = (state, code, here, after)
        found = self.known.get(key)
        if found is None:
            letters = ""
            while True:
                if code is None and here[state] == 0 and state in (START, DONE):
                    break
                letter, state = least_edit(state, code, here, after)
                letters += letter
                if letter != "I":
                    break
            found = self.known[key] = (letters, state)
        return found


def runs_of(ends: list[bool]) -> Iterator[tuple[int, int]]:
    """Start and end of each conversation's rows in a chunk; `ends` marks the last row of one."""
    start = 0
    for k, last in enumerate(ends):
        if last:
            yield start, k + 1
            start = k + 1
    if start < len(ends):
        yield start, len(ends)


def text_of(column: str) -> Column:
    """A column as text, null as one blank."""
    return F.coalesce(F.col(column).cast("string"), F.lit(" "))


def damage(conversations: DataFrame) -> DataFrame:
    """Known damage to sound conversations, chosen by a checksum of id and turn, to try `repair` on.

    Of twenty remainders, 0 drops a row, 1 empties its text, 2 takes its sentence
    ends away, 3 repeats it and 4 makes it a user's. Nulls count as one blank in
    the checksum, in `role` and in `text`.
    """
    chosen = F.crc32(F.concat_ws(":", text_of("conv_id"), text_of("turn"))) % 20
    text = text_of("text")
    return (
        conversations.select("conv_id", "turn", text_of("role").alias("role"), text.alias("text"), chosen.alias("chosen"))
        .where("chosen <> 0")
        .select(
            F.col("conv_id").cast("long").alias("conv_id"),
            F.col("turn").cast("long").alias("turn"),
            F.when(F.col("chosen") == 4, "user").otherwise(F.col("role")).alias("role"),
            F.when(F.col("chosen") == 1, "")
            .when(F.col("chosen") == 2, F.regexp_replace("text", "[.!?]", ""))
            .otherwise(F.col("text"))
            .alias("text"),
            F.explode(F.when(F.col("chosen") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
        )
        .drop("copy")
    )


def stored_rows(conversations: DataFrame, staging: Staging) -> DataFrame:
    """A stored copy of the rows, each with an `id`; whole texts are sorted nowhere."""
    return staging.save(
        conversations.select(
            F.monotonically_increasing_id().alias("id"),
            F.col("conv_id").cast("long").alias("conv_id"),
            F.col("turn").cast("long").alias("turn"),
            text_of("role").alias("role"),
            text_of("text").alias("text"),
        ),
        "rows",
    )


def numbered_rows(rows: DataFrame, staging: Staging) -> DataFrame:
    """The narrow rows in order of conversation and turn, with their number `n`, and a hash of what was `said`.

    Nulls come first; rows of one turn go in the order of that hash.
    """
    said = F.concat_ws(":", F.length("role").cast("string"), F.col("role"), F.col("text"))
    initial = F.substring("role", 1, 1)
    narrow = rows.select(
        "id",
        "conv_id",
        "turn",
        F.unhex(F.sha2(said, 256)).alias("said"),
        F.when(initial == "u", 1).when(initial == "a", 2).when(initial == "s", 3).otherwise(0).alias("initial"),
        fault_of(F.lit(False)).alias("fault"),
    )
    order = [F.asc_nulls_first(c) for c in ("conv_id", "turn", "said")]
    return staging.save(dense_key(narrow, order, 0, "n", staging), "ordered")


def fault_of(duplicate: Column) -> Column:
    """Why a row is at fault: the first of blank, duplicate and truncated, or null.

    Blank is a text without a character that is not white space; a text is
    truncated if its last such character ends no sentence.
    """
    shown = F.rtrim(F.col("text"), F.lit(WHITE))
    return (
        F.when(shown == "", "blank")
        .when(duplicate, "duplicate")
        .when(~F.substring(shown, -1, 1).isin(".", "!", "?"), "truncated")
    )


def coded_chunks(rows: DataFrame, chunk_rows: int) -> DataFrame:
    """What the search runs on, a row a chunk: the codes of its rows, which of them end conversations.

    `goes_on` says that the chunk's last conversation continues in the next one.
    """
    firsts = rows.groupBy("conv_id", "said").agg(F.min("n").alias("n")).select("n", F.lit(True).alias("earliest"))
    narrow = rows.join(firsts, "n", "left")
    deleted = F.col("earliest").isNull() | (F.col("fault") == "blank")
    code = 2 * F.col("initial") + F.when(F.col("fault") == "truncated", 1).otherwise(0)
    coded = narrow.select(
        "n",
        "id",
        F.floor(F.col("n") / chunk_rows).cast("long").alias("chunk"),
        "conv_id",
        F.when(deleted, DELETED).otherwise(code).cast("int").alias("code"),
    )
    ends = ~F.lead("conv_id").over(Window.partitionBy("chunk").orderBy("n")).eqNullSafe(F.col("conv_id"))
    row = F.struct("n", "code", "ends", "conv_id", "id")
    chunks = coded.withColumn("ends", ends).groupBy("chunk").agg(F.sort_array(F.collect_list(row)).alias("rows"))
    edges = chunks.select(
        F.col("chunk"),
        F.transform("rows", lambda r: r["code"]).alias("codes"),
        F.transform("rows", lambda r: r["ends"]).alias("ends"),
        F.transform("rows", lambda r: r["id"]).alias("ids"),
        F.element_at("rows", 1)["conv_id"].alias("first_conv"),
        F.element_at("rows", -1)["conv_id"].alias("last_conv"),
    )
    following = edges.select((F.col("chunk") - 1).alias("chunk"), F.col("first_conv").alias("next_conv"), F.lit(True).alias("met"))
    # Within a chunk the last row has no successor, so its end is told by the next chunk.
    goes_on = F.col("met") & F.col("next_conv").eqNullSafe(F.col("last_conv"))
    return edges.join(following, "chunk", "left").select(
        "chunk", "codes", "ends", "ids", F.coalesce(goes_on, F.lit(False)).alias("goes_on")
    )


def _loaded(batch: pa.RecordBatch) -> Iterator[tuple[int, bytes, list[tuple[int, int]], bool]]:
    """Number, codes, runs of conversations and continuation of each chunk in a batch."""
    names = ("chunk", "codes", "ends", "goes_on")
    for chunk, codes, ends, goes_on in zip(*(batch.column(c).to_pylist() for c in names), strict=True):
        ends[-1] = True
        yield chunk, bytes(codes), list(runs_of(ends)), goes_on


VECTOR = "array<int>"


def backward_vectors(chunks: DataFrame, staging: Staging) -> tuple[DataFrame, int]:
    """The true vector after the last row of each chunk, as `chunk`, `end`, and the number of passes.

    `first` is the vector before a chunk's first row, which a chunk that lies
    wholly in one conversation hands on from its end.
    """

    def make_first():
        costs = Costs()

        def speculate(batch: pa.RecordBatch) -> dict:
            out: dict = {"chunk": [], "end": [], "first": [], "through": [], "goes_on": []}
            for chunk, codes, runs, goes_on in _loaded(batch):
                start, end = runs[0]
                out["chunk"].append(chunk)
                out["end"].append(END)
                out["first"].append(costs.back(codes[start:end], END)[0])
                out["through"].append(goes_on and len(runs) == 1)
                out["goes_on"].append(goes_on)
            return out

        return speculate

    schema = f"chunk long, end {VECTOR}, first {VECTOR}, through boolean, goes_on boolean"
    state = staging.save(map_batches(chunks, make_first, schema), "vectors")

    def make_again():
        costs = Costs()

        def fix(batch: pa.RecordBatch) -> dict:
            out: dict = {"chunk": [], "end": [], "first": []}
            told = zip(*(batch.column(c).to_pylist() for c in ("new", "end", "first")), strict=True)
            for (chunk, codes, _, _), (new, end, first) in zip(_loaded(batch), told, strict=True):
                out["chunk"].append(chunk)
                out["end"].append(new)
                out["first"].append(costs.rerun(codes, tuple(new), tuple(end), tuple(first)))
            return out

        return fix

    speculative = F.array(*[F.lit(cost) for cost in END])

    def stitched(state: DataFrame) -> DataFrame:
        """`state` with the vector after each chunk as `new`: what its neighbour begins with."""
        given = state.select((F.col("chunk") - 1).alias("chunk"), F.col("first").alias("new"))
        new = F.when(F.col("goes_on") & F.col("new").isNotNull(), F.col("new")).otherwise(speculative)
        return state.join(given, "chunk", "left").withColumn("new", new)

    for passes in itertools.count(1):
        met = stitched(state)
        wrong = staging.save(met.where("through AND new <> end").select("chunk", "new", "end", "first"), "wrong")
        if wrong.isEmpty():
            break
        if passes > FIXUPS:
            firsts, more = _firsts_by_transfer(chunks, state, staging)
            sure = state.join(firsts.withColumnRenamed("first", "sure"), "chunk", "left")
            met, passes = stitched(sure.withColumn("first", F.coalesce("sure", "first"))), passes + more
            break
        fixed = map_batches(
            chunks.join(wrong, "chunk"), make_again, f"chunk long, end {VECTOR}, first {VECTOR}"
        ).select("chunk", F.struct("end", "first").alias("fixed"))
        state = staging.save(
            state.join(fixed, "chunk", "left").select(
                "chunk",
                F.coalesce("fixed.end", "end").alias("end"),
                F.coalesce("fixed.first", "first").alias("first"),
                "through",
                "goes_on",
            ),
            "vectors",
        )
    return met.select("chunk", F.col("new").alias("end")), passes


def _firsts_by_transfer(chunks: DataFrame, state: DataFrame, staging: Staging) -> tuple[DataFrame, int]:
    """`chunk` and true `first` of the chunks that lie wholly in one conversation, and the number of passes.

    `costs` leads from a chunk's first row to the first row `reach` chunks on;
    each pass either meets a known vector there or doubles the reach.
    """

    def make():
        def costs_of(batch: pa.RecordBatch) -> dict:
            loaded = list(_loaded(batch))
            return {"chunk": [c for c, *_ in loaded], "costs": [transfer(codes) for _, codes, *_ in loaded]}

        return costs_of

    through = state.where("through").select("chunk")
    open_ = map_batches(chunks.join(through, "chunk"), make, f"chunk long, costs {VECTOR}")
    known = state.where("NOT through").select("chunk", "first", F.lit(None).cast(VECTOR).alias("costs"))
    table = staging.save(known.unionByName(open_, allowMissingColumns=True), "reach")
    states, reach, passes = "sequence(0, 3)", 1, 0
    led = f"transform({states}, s -> array_min(transform({states}, t -> costs[4 * s + t] + next_first[t])))"
    far = (
        "transform(sequence(0, 15), k -> array_min(transform(sequence(0, 3), "
        "m -> costs[4 * (k div 4) + m] + next_costs[4 * m + k % 4])))"
    )
    while not table.where("first IS NULL").isEmpty():
        after = table.select((F.col("chunk") - reach).alias("chunk"), F.col("first").alias("next_first"), F.col("costs").alias("next_costs"))
        met = table.join(after, "chunk", "left").withColumns({"led": F.expr(led), "far": F.expr(far)})
        table = staging.save(
            met.select(
                "chunk",
                F.coalesce("first", F.expr("if(next_first IS NULL, NULL, transform(led, c -> int(c - led[0])))")).alias("first"),
                F.expr(f"transform(far, c -> int(least(c - array_min(far), {NEVER})))").alias("costs"),
            ),
            "reach",
        )
        reach, passes = 2 * reach, passes + 1
    return table.join(through, "chunk").select("chunk", "first"), passes


def entry_states(chunks: DataFrame, staging: Staging) -> tuple[DataFrame, int]:
    """The state in which each chunk is entered, as `chunk`, `entry`, and the number of passes.

    `chunks` has the true `end` vectors. Only a chunk that lies wholly in one
    conversation leaves in a state that may depend on the one it is entered in.
    """

    def make():
        costs, tracer = Costs(), Tracer()

        def leave(batch: pa.RecordBatch) -> dict:
            out: dict = {"chunk": [], "leaving": [], "goes_on": []}
            for (chunk, codes, runs, goes_on), vector in zip(_loaded(batch), batch.column("end").to_pylist(), strict=True):
                leaving = [START] * 4
                if goes_on:
                    start, end = runs[-1]
                    vectors = costs.back(codes[start:end], tuple(vector))
                    entered = range(4) if start == 0 else [START]
                    for state in entered:
                        at = state
                        for k in range(start, end):
                            _, at = tracer.edits(at, codes[k], vectors[k - start], vectors[k - start + 1])
                        leaving[state] = at
                    if start:
                        leaving = [leaving[START]] * 4
                out["chunk"].append(chunk)
                out["leaving"].append(leaving)
                out["goes_on"].append(goes_on)
            return out

        return leave

    maps = staging.save(map_batches(chunks, make, "chunk long, leaving array<int>, goes_on boolean"), "leaving")
    before = maps.select((F.col("chunk") + 1).alias("chunk"), F.col("goes_on").alias("comes_on"), F.col("leaving").alias("enters"))
    joined = maps.join(before, "chunk", "left")
    # Known at once: where a conversation begins, and where all states leave the chunk before in one.
    alike = F.array_min("enters") == F.array_max("enters")
    entry = F.when(~F.coalesce("comes_on", F.lit(False)), START).when(alike, F.col("enters")[0])
    known = staging.save(joined.select("chunk", entry.alias("entry"), "enters"), "entries")
    reach = passes = 1
    while not known.where("entry IS NULL").isEmpty():
        told = known.select(
            (F.col("chunk") + reach).alias("chunk"), F.col("entry").alias("entered"), F.col("enters").alias("farther")
        )
        met = known.join(told, "chunk", "left")
        passed_on = F.coalesce("entry", F.element_at("enters", F.col("entered") + 1))
        enters = F.expr("coalesce(transform(farther, state -> enters[state]), enters)")
        known = staging.save(met.select("chunk", passed_on.alias("entry"), enters.alias("enters")), "entries")
        reach, passes = 2 * reach, passes + 1
    return known.select("chunk", "entry"), passes


def traced(chunks: DataFrame, chunk_rows: int) -> DataFrame:
    """The edits of every row `id` in order: `letters` from `state` on, `tail` after it from `tail_state` on.

    `forced` rows are blank or duplicates.

    `chunks` has the true `end` vectors and `entry` states.
    """

    def make():
        costs, tracer = Costs(), Tracer()

        def trace(batch: pa.RecordBatch) -> dict:
            out: dict = {name: [] for name in ("id", "n", "forced", "letters", "state", "tail", "tail_state")}
            told = zip(*(batch.column(c).to_pylist() for c in ("end", "entry", "ids")), strict=True)
            for (chunk, codes, runs, goes_on), (vector, entry, ids) in zip(_loaded(batch), told, strict=True):
                for start, end in runs:
                    open_ = goes_on and end == len(codes)
                    vectors = costs.back(codes[start:end], tuple(vector) if open_ else END)
                    state = entry if start == 0 else START
                    for k in range(start, end):
                        letters, after = tracer.edits(state, codes[k], vectors[k - start], vectors[k - start + 1])
                        tail = ""
                        if k + 1 == end and not open_:
                            tail, _ = tracer.edits(after, None, END, None)
                        out["id"].append(ids[k])
                        out["n"].append(chunk * chunk_rows + k)
                        out["forced"].append(codes[k] == DELETED)
                        out["letters"].append(letters)
                        out["state"].append(state)
                        out["tail"].append(tail)
                        out["tail_state"].append(after)
                        state = after
            return out

        return trace

    return map_batches(chunks, make, "id long, n long, forced boolean, letters string, state int, tail string, tail_state int")


def repair(conversations: DataFrame, staging: Staging, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """One row per edit of the cheapest repair of each conversation, in order of `n` and `k`.

    `conv_id`, `n` (number of the original row over the whole table), `k` (place among the
    edits at that row), `edit`, `turn`, `was` (the role before, null for inserts), `role`
    and `text` (after, null if deleted), `fault`, `cost`. Edits are Keep (0), Rerole to
    user or assistant (1), Delete (2, needed for blank and duplicate rows) and
    Insert of an empty text (5); a truncated row that stays adds 5. Among equally cheap
    repairs the one whose edits' initials are least in order is taken. Roles count by their
    first letter, in lower case; a row without one cannot be kept. A null role or text is one blank; rows without a
    conversation are one conversation; rows without a turn come first; repeated rows are
    duplicates. Texts may be of any length: the search reads their last character only.
    Conversations of any length are searched in chunks. Other columns are not read. An
    empty table gives no rows.
    """
    rows = stored_rows(conversations, staging)
    chunks = staging.save(coded_chunks(numbered_rows(rows, staging), chunk_rows), "chunks")
    ends, _ = backward_vectors(chunks, staging)
    chunks = staging.save(chunks.join(ends, "chunk"), "stitched")
    entries, _ = entry_states(chunks, staging)
    found = traced(chunks.join(entries, "chunk"), chunk_rows)

    def edits(letters: str, state: str) -> Column:
        """Each letter with the role that it gives: roles alternate from the state on."""
        first = F.when(F.col(state) == USER, 1).otherwise(0)
        return F.transform(
            F.filter(F.split(letters, ""), lambda c: c != ""),
            lambda c, k: F.struct(c.alias("edit"), F.when((first + k) % 2 == 1, "assistant").otherwise("user").alias("given")),
        )

    every = F.concat(edits("letters", "state"), edits("tail", "tail_state"))
    told = rows.join(found, "id").withColumn("fault", fault_of(F.col("forced")))
    edited = told.select("*", F.posexplode(every).alias("k", "e")).select("*", "e.*")
    edit, own = F.col("edit"), F.col("edit") != "I"
    fault = F.when(own, F.col("fault"))
    return edited.select(
        "conv_id",
        "n",
        "k",
        "edit",
        F.when(own, F.col("turn")).alias("turn"),
        F.when(own, F.col("role")).alias("was"),
        F.when(edit == "K", F.col("role")).when(edit != "D", F.col("given")).alias("role"),
        F.when(edit == "I", "").when(edit != "D", F.col("text")).alias("text"),
        fault.alias("fault"),
        (
            F.when(edit == "I", INSERT)
            .when(edit == "D", DELETE)
            .otherwise(F.when(edit == "R", RENAME).otherwise(0) + F.when(fault == "truncated", TRUNCATED).otherwise(0))
        )
        .cast("long")
        .alias("cost"),
    )


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def summary(edits: DataFrame) -> DataFrame:
    """One row per conversation of `repair`'s edits: faults before, cost, audit and hash of the repaired rows.

    One hash over a whole conversation can only be taken in order, so its rows
    stream through one task, sorted; besides the audit nothing of them is kept.
    """
    schema = pa.schema(
        [("conv_id", pa.int64()), *((c, pa.int64()) for c in COUNTS), ("audit", pa.string()), ("repaired_sha256", pa.string())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[dict] = []
        current: dict | None = None

        def close() -> None:
            turns, found = current.pop("turns"), current.pop("hash")
            lowest, highest, distinct = turns
            current["gaps"] = highest - lowest + 1 - distinct if distinct else 0
            current.pop("initial")
            current["audit"] = "".join(current["audit"])
            current["repaired_sha256"] = found.hexdigest()
            done.append(current)

        names = ("conv_id", "edit", "turn", "was", "role", "fault", "cost")
        for batch in batches:
            told = zip(*(batch.column(c).to_pylist() for c in names), batch.column("text"), strict=True)
            for conv, edit, turn, was, role, fault, cost, text in told:
                if current is None or current["conv_id"] != conv:
                    if current is not None:
                        close()
                    current = {"conv_id": conv, **dict.fromkeys(COUNTS, 0), "audit": []}
                    current |= {"turns": [0, 0, 0], "hash": hashlib.sha256(), "initial": None, "said": False}
                current["audit"].append(edit)
                current["cost"] += cost
                if edit != "I":
                    if turn is not None and (not current["turns"][2] or turn != current["turns"][1]):
                        lowest, _, distinct = current["turns"]
                        current["turns"] = [lowest if distinct else turn, turn, distinct + 1]
                    if fault is not None:
                        current[fault] += 1
                    if current["initial"] is not None:
                        current["illegal"] += current["initial"] + was[:1] not in ("su", "ua", "au")
                    current["initial"] = was[:1]
                if edit != "D":
                    message = f"{role}:{text.as_py()}"
                    current["hash"].update((("\n" if current["said"] else "") + message).encode())
                    current["said"] = True
            yield pa.RecordBatch.from_pylist([{n: d[n] for n in schema.names} for d in done], schema=schema)
            done.clear()
        if current is not None:
            close()
            yield pa.RecordBatch.from_pylist([{n: d[n] for n in schema.names} for d in done], schema=schema)

    ordered = edits.repartition("conv_id").sortWithinPartitions(F.asc_nulls_first("conv_id"), "n", "k")
    counts = ", ".join(f"{c} long" for c in COUNTS)
    return ordered.mapInArrow(run, f"conv_id long, {counts}, audit string, repaired_sha256 string")


def repaired_summary(conversations: DataFrame, edits: DataFrame) -> DataFrame:
    """`summary` with a row for every id in `conversations`, also those with no rows left to repair."""
    every = conversations.select(F.col("conv_id").cast("long").alias("conv")).distinct()
    found = every.join(summary(edits), F.col("conv").eqNullSafe(F.col("conv_id")), "left")
    return found.select(
        F.col("conv").alias("conv_id"),
        *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in COUNTS],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )
