"""Repair of conversations: the cheapest edits that give the roles (system?)(user assistant)+.

A row is blank (no character but ASCII white space), else a duplicate (role and text stand
earlier in its conversation), else truncated (its last such character is none of ``.!?``).  Keep
costs 0, a new role 3, deletion 4 (blank and duplicate rows must go), an inserted empty turn 3,
and a truncated row that stays 3.  Of several cheapest lists of edits the one whose initials
are least in ASCII order is taken.  Role names count by their first character, so only rows
whose role begins with ``s``, ``u`` or ``a`` can be kept.

Three states say what may follow (nothing yet, after the system turn, after a user turn, after
an assistant turn: four with the start), and a vector holds the least cost to the end from each.
The dynamic programme goes backward, then edits are chosen forward, and vectors are stored only
at checkpoints: a conversation is cut into blocks of at most ``2**BLOCK_BITS`` rows, and within
a block every square root of its rows has one; what lies between is computed again while
walking forward.  Blocks of one conversation are spread over tasks.  A block first becomes the
least cost between any two states at its ends; these small tables, one row a block, are chained
backward for the vector at each block's end and forward for the state at its start.  So no task
holds a conversation, however long; only its audit, which is a result, is one string, and only
:func:`digests` reads a conversation in one task, row by row, since SHA-256 allows nothing else.

Null roles and texts are one space, and so are null ids and turns where they are hashed; a
null ``conv_id`` is a conversation of its own, null turns come first.  Rows of the same turn are
ordered by role and text.  Texts of any length are read whole, repeated rows are duplicates,
and an empty table gives an empty result.  Only ``conv_id``, ``turn``, ``role`` and ``text`` are read."""

from __future__ import annotations

from math import isqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlake.llm.common import arrow_rows, on_workers, saved

BLOCK_BITS = 12
NEW_ROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
SOME = r"[^\x20\x09-\x0D]"

START, SYSTEM, USER, ASSISTANT = range(4)
NEVER = 1 << 60
#: The state that an inserted or renamed turn leads to, and that turn's role.
ONWARD = (USER, USER, ASSISTANT, USER)
ROLES = {USER: "user", ASSISTANT: "assistant"}
KEPT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
#: Rows that must be deleted.
GO = ("b", "d")
#: In place of a row: the end of the conversation.
END = "$"


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows with faults: by the checksum of ``conv_id:turn`` modulo 20 some are dropped (0), lose
    their text (1) or its ``.!?`` (2), are there twice (3) or get the role of the user (4)."""
    shown = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn")).cast("binary")) % 20
    text = F.when(fault == 1, F.lit("")).when(fault == 2, F.translate(shown("text"), ".!?", "")).otherwise(shown("text"))
    return conversations.filter(fault != 0).select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.when(fault == 4, F.lit("user")).otherwise(shown("role")).alias("role"),
        text.alias("text"),
        F.explode(F.when(fault == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"),
    ).drop("copy")


def in_order(rows: DataFrame) -> DataFrame:
    """A saved table of the rows with ``at``, which follows conversation, turn, role and text.

    It is sorted in ranges, so a long conversation lies in several."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    clean = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")])
    ranged = clean.repartitionByRange(parts, "conv_id", "turn", "role", F.substring("text", 1, 32))
    ranged = ranged.sortWithinPartitions("conv_id", "turn", "role", "text")
    return saved(ranged.withColumn("at", F.monotonically_increasing_id()), "turns")


def _block(at: str = "at") -> Column:
    return F.shiftright(at, BLOCK_BITS)


def faults(ordered: DataFrame) -> DataFrame:
    """conv_id, at, fault (``blank``, ``duplicate``, ``truncated`` or null) and initial of every row.

    Which rows stand first is joined by place, which is unique: a text repeated in a million
    turns makes no hot key."""
    names = [F.xxhash64(F.lit(i), "role", "text").alias(f"h{i}") for i in (1, 2)]
    blank = ~F.col("text").rlike(SOME)
    tail = F.substring(F.regexp_replace("text", r"[\x20\x09-\x0D]+\z", ""), -1, 1)
    light = ordered.select("conv_id", "at", *names, blank.alias("blank"), ~tail.isin(".", "!", "?") & ~blank, F.substring("role", 1, 1))
    light = saved(light.toDF("conv_id", "at", "h1", "h2", "blank", "cut", "initial"), "faults")
    first = light.groupBy("conv_id", "h1", "h2").agg(F.min("at").alias("at")).select("at", F.lit(True).alias("first"))
    fault = F.when(F.col("blank"), "blank").when(F.col("first").isNull(), "duplicate").when(F.col("cut"), "truncated")
    return light.join(first, "at", "left").select("conv_id", "at", fault.alias("fault"), "initial")


def blocks(found: DataFrame) -> DataFrame:
    """conv_id, at (of the first row) and codes of every block: a character a row, ``b`` for a blank
    one, ``d`` for a duplicate, else its role's initial (``o``: any other), a capital where the row is truncated."""
    known = F.when(F.col("initial").isin("s", "u", "a"), F.col("initial")).otherwise(F.lit("o"))
    code = (
        F.when(F.col("fault") == "blank", "b").when(F.col("fault") == "duplicate", "d")
        .when(F.col("fault") == "truncated", F.upper(known)).otherwise(known)
    )
    rows = found.select("conv_id", _block().alias("block"), F.struct("at", code.alias("code")).alias("row"))
    # at most 2**BLOCK_BITS rows each: that many values of ``at`` share a block
    listed = rows.groupBy("conv_id", "block").agg(F.array_sort(F.collect_list("row")).alias("rows"))
    return listed.select("conv_id", F.col("rows")[0]["at"].alias("at"), F.array_join(F.col("rows.code"), "").alias("codes"))


def before(code: str, after: tuple) -> tuple:
    """The vector in front of a row, from the one behind it; insertions there included."""
    if code == END:
        row = [after[START], NEVER, NEVER, after[ASSISTANT]]
    else:
        row = [DELETE + c for c in after]
        if code not in GO:
            more = TRUNCATED if code.isupper() else 0
            low = code.lower()
            for state in range(4):
                row[state] = min(row[state], NEW_ROLE + more + after[ONWARD[state]])
                if (to := KEPT.get((state, low))) is not None:
                    row[state] = min(row[state], more + after[to])
    user = min(row[USER], INSERT + row[ASSISTANT])
    assistant = min(row[ASSISTANT], INSERT + row[USER])
    return min(row[START], INSERT + user), min(row[SYSTEM], INSERT + user), user, assistant


def between(codes: str) -> list[int]:
    """Least costs from each state in front of the codes to each state behind them, by end state."""
    out = []
    for end in range(4):
        vector = tuple(0 if state == end else NEVER for state in range(4))
        for code in reversed(codes):
            vector = before(code, vector)
        out.extend(min(c, NEVER) for c in vector)
    return out


def walks(codes: str, end: tuple, states: list[int]) -> list[tuple[str, int]]:
    """For each state to begin in: the initials of the chosen edits and the state behind the codes.

    ``end`` is the vector behind the codes.  Vectors are stored a square root of the rows apart."""
    n = len(codes)
    gap = isqrt(max(n - 1, 0)) + 1
    stored, vector = {n: end}, end
    for i in range(n - 1, -1, -1):
        vector = before(codes[i], vector)
        if i % gap == 0:
            stored[i] = vector
    letters, now = [[] for _ in states], list(states)
    for low in range(0, n, gap):
        high = min(low + gap, n)
        again = [stored[high]]
        for i in range(high - 1, low - 1, -1):
            again.append(before(codes[i], again[-1]))
        again.reverse()
        for k, state in enumerate(now):
            for i in range(low, high):
                state = _edits(codes[i], again[i - low], again[i - low + 1], state, letters[k])
            now[k] = state
    return [("".join(chosen), state) for chosen, state in zip(letters, now)]


def _edits(code: str, here: tuple, after: tuple, state: int, out: list[str]) -> int:
    """Adds the edits in front of and at one row; gives the state behind it.  An edit is tight when
    its cost is the difference of the vectors; the least letter of the tight ones is taken."""
    low = code.lower()
    more = TRUNCATED if code.isupper() else 0
    while True:
        cost = here[state]
        if code != END and DELETE + after[state] == cost:
            out.append("D")
            return state
        if INSERT + here[ONWARD[state]] == cost:
            out.append("I")
            state = ONWARD[state]
            continue
        if code == END:
            return state
        to = KEPT.get((state, low))
        if to is not None and more + after[to] == cost:
            out.append("K")
            return to
        out.append("R")
        return ONWARD[state]


def _costed(batches):
    import pyarrow as pa

    for batch in batches:
        costs = [between(c) for c in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(costs, pa.list_(pa.int64()))], [*batch.schema.names, "costs"])


def _streamed(batches, new, step):
    """Rows with one more value: ``step(carried, row)`` gives the value and what the conversation's next
    row is told, ``new`` what its first one is told."""
    import pyarrow as pa

    known, carried = False, new
    conv = None
    for batch in batches:
        values = []
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if not known or row[0] != conv:
                known, conv, carried = True, row[0], new
            value, carried = step(carried, row)
            values.append(value)
        yield batch, pa.array(values)


def _with_ends(batches):
    """Blocks in descending order: the vector behind each, and whether it is the conversation's last."""
    import pyarrow as pa

    def step(end, row):
        costs = row[3]
        vector = before(END, (0, 0, 0, 0)) if end is None else end
        front = tuple(min(costs[4 * k + s] + vector[k] for k in range(4)) for s in range(4))
        return [int(end is None), *vector], front

    for batch, ends in _streamed(batches, None, step):
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], ends.cast(pa.list_(pa.int64()))], ["conv_id", "at", "codes", "ends"])


def _walked(codes: str, ends: list[int], states: list[int]) -> list[tuple[str, int]]:
    last, *vector = ends
    return walks(codes + END, (0, 0, 0, 0), states) if last else walks(codes, tuple(vector), states)


def _with_exits(batches):
    import pyarrow as pa

    for batch in batches:
        pairs = zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())
        exits = [[state for _, state in _walked(codes, ends, [0, 1, 2, 3])] for codes, ends in pairs]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(exits, pa.list_(pa.int64()))], [*batch.schema.names, "exits"])


def _with_entries(batches):
    """Blocks in ascending order: the state in front of each."""
    import pyarrow as pa

    for batch, entry in _streamed(batches, START, lambda state, row: (state, row[4][state])):
        yield pa.RecordBatch.from_arrays([*batch.columns[:4], entry.cast(pa.int64())], ["conv_id", "at", "codes", "ends", "entry"])


def _edited(batches):
    """The edits of whole blocks: each block's own row comes first, then its turns."""
    import pyarrow as pa

    names = ["conv_id", "at", "is_turn", "codes", "ends", "entry", "turn", "role", "text"]
    fault_of = {"b": "blank", "d": "duplicate", **dict.fromkeys("SUAO", "truncated")}
    kinds = [pa.int64(), pa.int32(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string()]
    letters, state, left, faulty = iter(""), START, 0, ""
    out: list[tuple] = []
    size, conv_type = 0, None

    def batch():
        columns = [pa.array(c, k) for c, k in zip(zip(*out), [conv_type, *kinds])]
        return pa.RecordBatch.from_arrays(columns, ["conv_id", "at", "step", "edit", "turn", "fault", "was", "role", "text"])

    for given in batches:
        conv_type = given.schema.field("conv_id").type
        for conv, at, is_turn, codes, ends, entry, turn, role, text in arrow_rows([given], *names):
            if not is_turn:
                state, left, faulty = entry, len(codes), codes
                letters = iter(_walked(codes, ends, [entry])[0][0])
                continue
            fault = fault_of.get(faulty[-left])
            left -= 1
            step, done = 0, False
            for letter in letters:
                if letter == "D":
                    out.append((conv, at, step, letter, turn, fault, role, None, None))
                elif letter == "K":
                    state = KEPT[state, role[0]]
                    out.append((conv, at, step, letter, turn, fault, role, role, text))
                else:
                    state = ONWARD[state]
                    own = letter == "R"
                    out.append((conv, at, step, letter, *((turn, fault, role) if own else (None, None, None)), ROLES[state], text if own else ""))
                step += 1
                done |= letter != "I"
                if done and left:  # what follows the block's last turn belongs to it as well
                    break
            size += len(text) + 64
            if size > 1 << 20:
                yield batch()
                out, size = [], 0
    if out:
        yield batch()


def edits(rows: DataFrame) -> DataFrame:
    """One row per edit: conv_id, at and step (their order), edit (``K``, ``R``, ``D`` or ``I``), turn, fault
    and was (the row's own, null for insertions), role and text (as repaired, null for deletions)."""
    spark = rows.sparkSession
    on_workers(spark)
    ordered = in_order(rows)
    conv = ordered.schema["conv_id"].dataType.simpleString()
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shape = f"conv_id {conv}, at long, codes string"
    costed = blocks(faults(ordered)).mapInArrow(_costed, f"{shape}, costs array<long>")
    ends = costed.repartition(parts, "conv_id").sortWithinPartitions("conv_id", F.desc("at"))
    ends = ends.mapInArrow(_with_ends, f"{shape}, ends array<long>").repartition(parts, "at")
    exits = ends.mapInArrow(_with_exits, f"{shape}, ends array<long>, exits array<long>")
    entries = exits.repartition(parts, "conv_id").sortWithinPartitions("conv_id", "at")
    entries = saved(entries.mapInArrow(_with_entries, f"{shape}, ends array<long>, entry long"), "entries")
    turns = ordered.withColumn("is_turn", F.lit(True))
    both = entries.withColumn("is_turn", F.lit(False)).unionByName(turns, allowMissingColumns=True)
    both = both.withColumn("block", _block()).repartition(parts, "block").sortWithinPartitions("at", "is_turn")
    schema = f"conv_id {conv}, at long, step int, edit string, turn long, fault string, was string, role string, text string"
    return both.mapInArrow(_edited, schema)


def _digested(batches):
    """One row per conversation from its edits in order; the first of them only names it."""
    import hashlib

    import pyarrow as pa

    names = ["conv_id", "at", "edit", "turn", "fault", "was", "role", "text"]
    columns = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    out: list[tuple] = []
    conv_type, held = None, None

    def batch():
        kinds = [conv_type, *[pa.int64()] * 6, pa.string(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], columns)

    def row():
        gaps = held["high"] - held["low"] + 1 - held["turns"] if held["turns"] else 0
        counts = [held[f] for f in ("blank", "duplicate", "truncated")]
        return (held["conv"], gaps, *counts, held["illegal"], held["cost"], "".join(held["audit"]), held["hash"].hexdigest())

    for given in batches:
        conv_type = given.schema.field("conv_id").type
        for conv, at, edit, turn, fault, was, role, text in arrow_rows([given], *names):
            if at < 0:
                if held is not None:
                    out.append(row())
                    if len(out) >= 4096:
                        yield batch()
                        out = []
                held = dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "cost", "turns"), 0)
                held |= {"conv": conv, "low": None, "high": None, "was": None, "audit": [], "hash": hashlib.sha256(), "any": False}
                continue
            held["audit"].append(edit)
            held["cost"] += {"K": 0, "R": NEW_ROLE, "D": DELETE, "I": INSERT}[edit]
            if edit != "I":
                if fault:
                    held[fault] += 1
                    held["cost"] += TRUNCATED if fault == "truncated" and edit != "D" else 0
                if held["was"] is not None and held["was"][:1] + was[:1] not in ("su", "ua", "au"):
                    held["illegal"] += 1
                held["was"] = was
                if turn is not None and turn != held["high"]:  # turns ascend
                    held["turns"] += 1
                    held["low"] = turn if held["low"] is None else held["low"]
                    held["high"] = turn
            if edit != "D":
                held["hash"].update((("\n" if held["any"] else "") + f"{role}:{text}").encode())
                held["any"] = True
    if held is not None:
        out.append(row())
    if out:
        yield batch()


def digests(conversations: DataFrame, found: DataFrame) -> DataFrame:
    """A row per conversation of ``conversations``: gaps in its turns, faults, illegal neighbours, cost and
    audit of its edits ``found``, and the SHA-256 of what they leave."""
    conv = found.schema["conv_id"].dataType.simpleString()
    named = conversations.select(F.col("conv_id").cast(conv).alias("conv_id")).distinct().withColumn("at", F.lit(-1).cast("long"))
    every = found.unionByName(named, allowMissingColumns=True)
    parts = int(found.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    every = every.repartition(parts, "conv_id").sortWithinPartitions("conv_id", "at", "step")
    schema = f"conv_id {conv}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
    return every.mapInArrow(_digested, schema)
