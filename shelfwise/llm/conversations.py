"""Conversation structure repair: a rank-convergence parallel Viterbi.

The rows of a conversation, in turn order, are to become an optional system row
and then user and assistant rows in turn, by the cheapest edits.  The costs of
going on from each of four states (nothing yet, after system, after user, after
assistant) form a vector per row, computed backwards.  Conversations are cut
into chunks by a range sort, so that a very long one is spread over many tasks.
Every chunk starts from a speculative vector at its right end; fix-up passes
hand it its neighbour's vector and run again until a row's vector differs from
the one before by a constant only, from where nothing changes but the constant.
Rows that must be deleted never bring vectors together, so chunks of such rows
are passed over, and chunks that have not settled after a few passes (rows of one
role keep two vectors apart for ever) are settled exactly by doubling.  The
stitched vectors then drive a forward trace to the least audit string.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from shelfwise.llm.common import n_partitions, stage

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1     # costs
START, AFTER_SYSTEM, AFTER_USER, AFTER_ASSISTANT = range(4)
ONWARD = (AFTER_USER, AFTER_USER, AFTER_ASSISTANT, AFTER_USER)      # state after the role that is due
DUE = ("user", "assistant")                                         # that role, for ONWARD - AFTER_USER
FAR = 1 << 40
END = (0, 4, 2, 0)              # costs after the last row: two, one or no inserts to come
TRAILING = ("", "II", "I", "")

# A row's code: initial (0 s, 1 u, 2 a, 3 other) + 4 * fault.
NO_FAULT, CUT_SHORT, BLANK, DUPLICATE = range(4)
LEGAL = {(0, 1), (1, 2), (2, 1)}

_VISIBLE = r"[^\x20\x09-\x0D]"


def _kept(initial: int, state: int) -> int | None:
    """State after keeping a row, None where its role is not allowed."""
    if initial == 0:
        return AFTER_SYSTEM if state == START else None
    if initial == 1:
        return AFTER_USER if state != AFTER_USER else None
    return AFTER_ASSISTANT if initial == 2 and state == AFTER_USER else None


def _step(after: tuple, code: int) -> tuple[tuple, tuple]:
    """(costs before the row, per state (audit letters for it, next state)); the
    letters are the least of those that reach the costs."""
    fault, initial = code >> 2, code & 3
    options = []                                    # per state: (letter, cost, next state) in letter order
    for state in range(4):
        found = [("D", DELETE + after[state], state)]
        if fault < BLANK:
            extra, kept = TRUNCATED * (fault == CUT_SHORT), _kept(initial, state)
            if kept is not None:
                found.append(("K", KEEP + extra + after[kept], kept))
            found.append(("R", REROLE + extra + after[ONWARD[state]], ONWARD[state]))
        options.append(found)
    costs = [min(c for _, c, _ in found) for found in options]
    for _ in range(3):                              # inserts before the row
        costs = [min(c, INSERT + costs[ONWARD[s]]) for s, c in enumerate(costs)]
    moves = []
    for start in range(4):
        letters, state = "", start
        while True:
            letter, cost, then = options[state][0]
            if cost != costs[state]:
                if INSERT + costs[ONWARD[state]] == costs[state]:
                    letters, state = letters + "I", ONWARD[state]
                    continue
                letter, _, then = next(o for o in options[state] if o[1] == costs[state])
            moves.append((letters + letter, then))
            break
    return tuple(costs), tuple(moves)


class Steps(dict):
    """(vector, code) -> (vector before the row, least entry 0; constant; moves).
    Vectors are small differences, so few are ever met."""

    def __missing__(self, key):
        costs, moves = _step(*key)
        least = min(costs)
        value = self[key] = (tuple(c - least for c in costs), least, moves)
        return value


def backward(codes: bytes, right: tuple, steps: Steps, known: list | None = None) -> list:
    """Vectors before each row and after the last, from ``right``.  With ``known``
    vectors of an earlier run it stops as soon as they agree but for a constant
    (vectors have least entry 0, so then they are equal)."""
    vectors = [right]
    for at in range(len(codes) - 1, -1, -1):
        vectors.append(steps[vectors[-1], codes[at]][0])
        if known is not None and vectors[-1] == known[at]:
            return known[:at] + vectors[::-1]
    return vectors[::-1]


def trace(codes: bytes, vectors: list, state: int, steps: Steps) -> tuple[str, int]:
    """Least audit letters from ``state`` over a chunk, and the state after it."""
    letters = []
    for at, code in enumerate(codes):
        part, state = steps[vectors[at + 1], code][2][state]
        letters.append(part)
    return "".join(letters), state


def transfer(codes: bytes) -> list[int]:
    """Least costs from each state before the chunk (rows) to each state after it
    (columns), as a flat 4 x 4 matrix."""
    steps, out = Steps(), [0] * 16
    for goal in range(4):
        vector, total = tuple(0 if s == goal else FAR for s in range(4)), 0
        for code in reversed(codes):
            vector, constant, _ = steps[vector, code]
            vector, total = tuple(min(c, FAR) for c in vector), total + constant
        for state in range(4):
            out[4 * state + goal] = min(total + vector[state], FAR)
    return out


# ---------------------------------------------------------------- rows

def damage(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) after damage by crc32(conv_id:turn) % 20: 0
    drops the row, 1 empties its text, 2 takes away its ``.!?``, 3 repeats it, 4
    sets role user.  Nulls are written as one space."""
    def shown(c):
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))
    draw = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn")).cast("binary")) % 20
    return (conversations.select("conv_id", "turn", shown("role").alias("role"), shown("text").alias("text"),
                                 draw.alias("draw")).where("draw <> 0")
            .select("conv_id", "turn", F.when(F.col("draw") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
                    F.when(F.col("draw") == 1, F.lit("")).when(F.col("draw") == 2, F.translate("text", ".!?", ""))
                    .otherwise(F.col("text")).alias("text"),
                    F.explode(F.array_repeat(F.lit(0), F.when(F.col("draw") == 3, 2).otherwise(1).cast("int")))
                    .alias("copy")).drop("copy"))


def _prepared(rows: DataFrame) -> DataFrame:
    """Rows with nulls as one space and ``digest``, which equals for equal (role, text)."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    plain = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"))
    whole = F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))
    return plain.withColumn("digest", F.unhex(F.sha2(whole.cast("binary"), 256)))


def _code() -> Column:
    initial = F.when(F.col("role").startswith("s"), 0).when(F.col("role").startswith("u"), 1).when(
        F.col("role").startswith("a"), 2).otherwise(3)
    fault = F.when(~F.col("text").rlike(_VISIBLE), BLANK).when(
        F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z"), NO_FAULT).otherwise(CUT_SHORT)
    return (initial + 4 * fault).cast("int")


# -------------------------------------------------------------- chunks

_CHUNK = ("pid int, seq long, lives long, live boolean, conv_id {conv_id}, turn {turn}, digest binary, codes binary, "
          "first_turn {turn}, last_turn {turn}, turns long")


def _cut(size: int, types: dict[str, pa.DataType]):
    """Sorted (conv_id, turn, digest, code, n, again) rows -> chunks of at most ``size`` rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pid, seq, lives = TaskContext.get().partitionId(), 0, 0
        held, out = None, []

        def close():
            nonlocal seq, lives, held
            if held is not None:
                conv, turn, digest, codes, first, last, turns = held
                live = any(c >> 2 < BLANK for c in codes)
                out.append((pid, seq, lives, live, conv, turn, digest, bytes(codes), first, last, turns))
                seq, lives, held = seq + 1, lives + live, None

        def flush():
            rows, out[:] = list(out), []
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types.values(), strict=True)],
                names=list(types))

        for batch in batches:
            for row in batch.to_pylist():
                conv, turn, code, left, fresh = row["conv_id"], row["turn"], row["code"], row["n"], not row["again"]
                repeated = code if code >> 2 == BLANK else (code & 3) + 4 * DUPLICATE
                while left:
                    if held is not None and (held[0] != conv or len(held[3]) >= size):
                        close()
                    if held is None:
                        held = [conv, turn, row["digest"], bytearray(), None, None, 0]
                    if turn is not None and turn != held[5]:
                        held[4], held[5], held[6] = turn if held[4] is None else held[4], turn, held[6] + 1
                    # one row's copies: the first, then duplicates
                    take = 1 if fresh else min(left, size - len(held[3]))
                    held[3].extend(bytes([code if fresh else repeated]) * take)
                    left, fresh = left - take, False
                if len(out) >= 512:
                    yield flush()
        close()
        if out:
            yield flush()
    return run


def _chunks(prepared: DataFrame, size: int) -> DataFrame:
    """Staged chunks of all rows: gid (gapless in order of conversations and
    rows), lid (live chunks before it) and the row codes."""
    spark = prepared.sparkSession
    turns = stage(prepared.select("conv_id", "turn", "digest", _code().alias("code"))
                  .groupBy("conv_id", "turn", "digest", "code").agg(F.count("*").alias("n")), "turns")
    # equal rows of other turns, in the few cases where there are any
    first = (turns.groupBy("conv_id", "digest").agg(F.min(F.struct("turn")).alias("first"), F.count("*").alias("c"))
             .where("c > 1").select(F.col("conv_id").alias("of"), F.col("digest").alias("same"), "first"))
    marked = (turns.join(first, F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("digest") == F.col("same")), "left")
              .select("conv_id", "turn", "digest", "code", "n",
                      (F.col("first").isNotNull() & ~F.col("first.turn").eqNullSafe(F.col("turn"))).alias("again")))
    key = ["conv_id", "turn", "digest"]
    names = {c: prepared.schema[c].dataType for c in ("conv_id", "turn")}
    schema = _CHUNK.format(**{c: t.simpleString() for c, t in names.items()})
    arrow = {"pid": pa.int32(), "seq": pa.int64(), "lives": pa.int64(), "live": pa.bool_(),
             "conv_id": to_arrow_type(names["conv_id"]), "turn": to_arrow_type(names["turn"]), "digest": pa.binary(),
             "codes": pa.binary(), "first_turn": to_arrow_type(names["turn"]),
             "last_turn": to_arrow_type(names["turn"]), "turns": pa.int64()}
    cut = stage(marked.repartitionByRange(n_partitions(spark), *key).sortWithinPartitions(*key)
                .mapInArrow(_cut(size, arrow), schema), "chunks")
    # one small row per sorted partition; their number is a setting, not the data's size
    totals = sorted(cut.groupBy("pid").agg(F.count("*").alias("n"), F.sum(F.col("live").cast("long")).alias("l"))
                    .collect())
    ends = np.cumsum([[0, 0]] + [[r["n"], r["l"]] for r in totals], axis=0).tolist()
    before = spark.createDataFrame([(r["pid"], *e) for r, e in zip(totals, ends, strict=False)],
                                   "pid int, chunks_before long, lives_before long")
    return (cut.join(F.broadcast(before), "pid")
            .withColumn("gid", F.col("chunks_before") + F.col("seq"))
            .withColumn("lid", F.col("lives_before") + F.col("lives"))
            .drop("pid", "seq", "lives", "chunks_before", "lives_before"))


# ------------------------------------------------------------ solving

def _packed(vectors: list) -> bytes:
    return bytes(c for v in vectors for c in v)


def _unpacked(data: bytes) -> list:
    return [tuple(data[i:i + 4]) for i in range(0, len(data), 4)]


def _per_row(columns: dict[str, pa.DataType | None], make: Callable):
    """Arrow function: ``make(row dict, steps)`` gives the values of ``columns``
    (type None: the input's own)."""
    def run(batches):
        steps = Steps()
        for batch in batches:
            rows = [make(row, steps) for row in batch.to_pylist()]
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t or batch.schema.field(n).type)
                     for (n, t), c in zip(columns.items(), zip(*rows, strict=True), strict=True)], names=list(columns))
    return run


def _speculate(row, steps):
    return row["lid"], row["conv_id"], row["codes"], _packed(backward(row["codes"], END, steps)), True


def _fix_up(row, steps):
    """The chunk from its neighbour's vector (none: its own end); moved: its first vector is another one now."""
    known = _unpacked(row["vectors"])
    right = tuple(row["right"]) if row["right"] is not None else known[-1]
    vectors = backward(row["codes"], right, steps, known) if right != known[-1] else known
    return row["lid"], row["conv_id"], row["codes"], _packed(vectors), vectors[0] != known[0]


def _scan(table: DataFrame, compose: Callable[[Column, Column], Column], name: str) -> DataFrame:
    """Pointer doubling over (lid, jump, value): values along the chain of jumps
    composed, in as many rounds as the logarithm of the longest chain."""
    while not table.where("jump is not null").isEmpty():
        far = table.select(F.col("lid").alias("o_lid"), F.col("jump").alias("o_jump"), F.col("value").alias("o_value"))
        table = stage(table.join(far, F.col("jump") == F.col("o_lid"), "left").select(
            "lid", F.col("o_jump").alias("jump"),
            F.when(F.col("o_value").isNull(), F.col("value")).otherwise(compose(F.col("value"), F.col("o_value")))
            .alias("value")), name)
    return table


def _min_plus(a: Column, b: Column) -> Column:
    def entry(k):
        return F.array_min(F.transform(F.sequence(F.lit(0), F.lit(3)), lambda m: F.get(
            a, (k - k % 4 + m).cast("int")) + F.get(b, (m * 4 + k % 4).cast("int"))))
    return F.transform(F.sequence(F.lit(0), F.lit(15)), lambda k: F.least(entry(k), F.lit(FAR)))


def _neighbours(table: DataFrame, columns: dict[str, Column], shift: int) -> DataFrame:
    """``table`` with ``columns`` of the live chunk ``shift`` further in the same conversation, else null."""
    beside = table.select((F.col("lid") - shift).alias("o_lid"), F.col("conv_id").alias("o_conv"),
                          *[c.alias(n) for n, c in columns.items()])
    return table.join(beside, (F.col("lid") == F.col("o_lid")) & F.col("conv_id").eqNullSafe(F.col("o_conv")),
                      "left").drop("o_lid", "o_conv")


def _settled(chunks: DataFrame, passes: int) -> DataFrame | None:
    """(lid, right, entry): the vector after and the state before each live chunk
    of the conversations that have several; None where there are none."""
    live = chunks.where("live").select("lid", "conv_id", "codes")
    several = live.groupBy(F.col("conv_id").alias("of")).count().where("count > 1")
    own = live.schema["conv_id"].dataType.simpleString()
    columns = {"lid": None, "conv_id": None, "codes": None, "vectors": pa.binary(), "moved": pa.bool_()}
    schema = f"lid long, conv_id {own}, codes binary, vectors binary, moved boolean"
    table = stage(live.join(several, F.col("conv_id").eqNullSafe(F.col("of"))).select("lid", "conv_id", "codes")
                  .mapInArrow(_per_row(columns, _speculate), schema), "vectors")
    if table.isEmpty():
        return None

    def fix(table, right):
        given = _neighbours(table, {"right": right}, 1)
        return stage(given.select("lid", "conv_id", "codes", "vectors", "right")
                     .mapInArrow(_per_row(columns, _fix_up), schema), "vectors")
    moving = True
    for _ in range(passes):
        table = fix(table, F.substring("vectors", 1, 4))
        if not (moving := not table.where("moved").isEmpty()):
            break
    if moving:                  # exactly, by doubling: matrices of all that follows
        matrices = _neighbours(table, {"jump": F.col("lid")}, 1).select("lid", "conv_id", "codes", "jump").mapInArrow(
            _per_row({"lid": None, "jump": None, "value": pa.list_(pa.int64())},
                     lambda row, _: (row["lid"], row["jump"], transfer(row["codes"]))),
            "lid long, jump long, value array<long>")
        whole = _scan(stage(matrices, "matrices"), _min_plus, "matrices").select(F.col("lid").alias("m_lid"), "value")

        def left(row, steps):
            costs = [min(row["value"][4 * s + t] + END[t] for t in range(4)) for s in range(4)]
            return (*(row[c] for c in ("lid", "conv_id", "codes", "vectors")),
                    bytes(c - min(costs) for c in costs))
        lefts = stage(table.join(whole, F.col("lid") == F.col("m_lid")).mapInArrow(
            _per_row({"lid": None, "conv_id": None, "codes": None, "vectors": None, "first": pa.binary()}, left),
            f"lid long, conv_id {own}, codes binary, vectors binary, first binary"), "lefts")
        table = fix(lefts, F.col("first"))

    def exits(row, steps):
        vectors = _unpacked(row["vectors"])
        ends = [trace(row["codes"], vectors, s, steps)[1] for s in range(4)]
        return row["lid"], row["conv_id"], row["vectors"][-4:], None if len(set(ends)) == 1 else row["before"], ends
    maps = stage(_neighbours(table, {"before": F.col("lid")}, -1).drop("moved").mapInArrow(
        _per_row({"lid": None, "conv_id": None, "right": pa.binary(), "jump": pa.int64(),
                  "value": pa.list_(pa.int32())}, exits),
        f"lid long, conv_id {own}, right binary, jump long, value array<int>"), "exits")
    composed = _scan(maps.select("lid", "jump", "value"),
                     lambda later, earlier: F.transform(earlier, lambda s: F.get(later, s)), "exits")
    after = composed.select((F.col("lid") + 1).alias("o_lid"), F.get("value", F.lit(START)).alias("entry"))
    firsts = maps.groupBy(F.col("conv_id").alias("of")).agg(F.min("lid").alias("first_lid"))
    return stage(maps.select("lid", "conv_id", "right").join(after, F.col("lid") == F.col("o_lid"), "left")
                 .join(firsts, F.col("conv_id").eqNullSafe(F.col("of")))
                 .select("lid", "right", F.when(F.col("lid") == F.col("first_lid"), START).otherwise(F.col("entry"))
                         .cast("int").alias("entry")), "settled")


# ------------------------------------------------------------- results

class _Conversation:
    """Counts, audit and repaired rows of one conversation, met in order."""

    def __init__(self, conv_id):
        self.conv_id, self.state, self.position = conv_id, START, 0
        self.letters: deque[str] = deque()
        self.audit: list[str] = []
        self.counts = np.zeros(4, np.int64)
        self.illegal = self.cost = self.turns = 0
        self.last_initial = self.first_turn = self.last_turn = None

    def chunk(self, row) -> None:
        codes = np.frombuffer(row["codes"], np.uint8)
        letters = np.frombuffer(row["letters"].encode(), np.uint8)
        self.letters.extend(row["letters"])
        self.audit.append(row["letters"])
        self.counts += np.bincount(codes >> 2, minlength=4)
        initials = codes & 3
        pairs = list(zip(initials[:-1].tolist(), initials[1:].tolist(), strict=True))
        if self.last_initial is not None:
            pairs.append((self.last_initial, int(initials[0])))
        self.illegal += sum(p not in LEGAL for p in pairs)
        self.last_initial = int(initials[-1])
        own = letters[letters != ord("I")]
        self.cost += int(INSERT * (len(letters) - len(own)) + DELETE * (own == ord("D")).sum()
                         + REROLE * (own == ord("R")).sum()
                         + TRUNCATED * ((own != ord("D")) & (codes >> 2 == CUT_SHORT)).sum())
        if row["turns"]:
            self.turns += row["turns"] - (row["first_turn"] == self.last_turn)
            self.first_turn = row["first_turn"] if self.first_turn is None else self.first_turn
            self.last_turn = row["last_turn"]

    def _insert(self):
        role = DUE[ONWARD[self.state] - AFTER_USER].encode()
        self.state = ONWARD[self.state]
        return role, b"", "I", None

    def row(self, turn, role: bytes, text: bytes) -> Iterator[tuple]:
        """(role, text, edit, turn) of the repaired rows up to this one."""
        while True:
            letter = self.letters.popleft()
            if letter == "I":
                yield self._insert()
                continue
            if letter == "R":
                role, self.state = DUE[ONWARD[self.state] - AFTER_USER].encode(), ONWARD[self.state]
            elif letter == "K":
                self.state = _kept({b"s": 0, b"u": 1, b"a": 2}.get(role[:1], 3), self.state)
            if letter != "D":
                yield role, text, letter, turn
            return

    def end(self) -> Iterator[tuple]:
        while self.state in (AFTER_SYSTEM, AFTER_USER):
            self.cost += INSERT
            self.audit.append("I")
            yield self._insert()

    @property
    def gaps(self) -> int:
        return self.last_turn - self.first_turn + 1 - self.turns if self.turns else 0


def _letters(row, steps):
    """Audit letters of one chunk."""
    if row["live"]:
        right = tuple(row["right"]) if row["right"] is not None else END
        vectors = backward(row["codes"], right, steps)
        letters = trace(row["codes"], vectors, row["entry"] or START, steps)[0]
    else:
        letters = "D" * len(row["codes"])
    return (*(row[c] for c in ("conv_id", "turn", "digest", "gid", "codes", "first_turn", "last_turn", "turns")), letters)


def _merged(rows: DataFrame, original: DataFrame, chunk_rows: int, passes: int) -> DataFrame:
    """One partition per hash of conv_id, sorted: a head for each conversation,
    then before the rows of each chunk its letters and codes."""
    spark, prepared = rows.sparkSession, _prepared(rows)
    chunks = _chunks(prepared, chunk_rows)
    settled = _settled(chunks, passes)
    own, turn = (prepared.schema[c].dataType.simpleString() for c in ("conv_id", "turn"))
    if settled is None:
        solved = chunks.withColumn("right", F.lit(None).cast("binary")).withColumn("entry", F.lit(None).cast("int"))
    else:
        solved = chunks.join(settled.withColumn("live", F.lit(True)), ["lid", "live"], "left")
    lettered = solved.mapInArrow(
        _per_row({"conv_id": None, "turn": None, "digest": None, "gid": None, "codes": None, "first_turn": None,
                  "last_turn": None, "turns": None, "letters": pa.string()}, _letters),
        f"conv_id {own}, turn {turn}, digest binary, gid long, codes binary, first_turn {turn}, last_turn {turn}, "
        "turns long, letters string").withColumn("tag", F.lit(1))
    heads = original.select("conv_id").distinct().withColumn("tag", F.lit(0))
    texts = prepared.select("conv_id", "turn", "digest", F.col("role").cast("binary").alias("role"),
                            F.col("text").cast("binary").alias("text"), F.lit(2).alias("tag"))
    order = ["conv_id", "turn", "digest", "tag", "gid"]
    return (heads.unionByName(lettered, allowMissingColumns=True).unionByName(texts, allowMissingColumns=True)
            .select(*order, "role", "text", "letters", "codes", "first_turn", "last_turn", "turns")
            .repartition(n_partitions(spark), "conv_id").sortWithinPartitions(*order))


def _walk(batches, ended: Callable[[_Conversation], None], repaired: Callable[[_Conversation, Iterator], None]):
    """Hands every conversation's repaired rows to ``repaired`` as they come and
    itself to ``ended``; one row and one chunk are held."""
    conv = None

    def close():
        if conv is not None:
            repaired(conv, conv.end())
            ended(conv)
    for batch in batches:
        for row in batch.to_pylist():
            if row["tag"] == 0:
                close()
                conv = _Conversation(row["conv_id"])
            elif row["tag"] == 1:
                conv.chunk(row)
            else:
                repaired(conv, conv.row(row["turn"], row["role"], row["text"]))
        yield
    close()
    yield


def _digests(types: dict[str, pa.DataType]):
    def run(batches):
        out, hashes = [], {}

        def repaired(conv, rows):
            for role, text, _, _ in rows:
                if conv not in hashes:
                    hashes[conv] = hashlib.sha256(role + b":" + text)
                else:
                    hashes[conv].update(b"\n" + role + b":" + text)

        def ended(conv):
            _, cut, blank, duplicate = conv.counts.tolist()
            out.append((conv.conv_id, conv.gaps, blank, duplicate, cut, conv.illegal, conv.cost, "".join(conv.audit),
                        hashes.pop(conv, hashlib.sha256()).hexdigest()))
        for _ in _walk(batches, ended, repaired):
            if out:
                rows, out[:] = list(out), []
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types.values(), strict=True)],
                    names=list(types))
    return run


def audit(rows: DataFrame, original: DataFrame | None = None, chunk_rows: int = 128, passes: int = 4) -> DataFrame:
    """Per conversation of ``original`` (default: ``rows``): conv_id, gaps, blank,
    duplicate, truncated, illegal, cost, audit, repaired_sha256.

    ``rows``: conv_id, turn, role, text; rows are taken by turn, nulls first, and
    at one turn by the SHA-256 of role and text.  A null role or text counts as
    one space; a row whose role starts with none of s, u, a (an empty one too)
    cannot be kept.  Equal rows beyond the first are duplicates; a null conv_id is
    a conversation of its own; very long texts are ordinary ones; other columns
    are ignored; conversations without rows get zeros and empty strings' results;
    an empty table gives no rows.  A conversation is searched in chunks of
    ``chunk_rows`` on many tasks; only the SHA-256 of its repaired rows, which is
    sequential, is read by one task, as a sorted stream.
    """
    original = rows if original is None else original
    merged = _merged(rows, original, chunk_rows, passes)
    own = merged.schema["conv_id"].dataType
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    arrow = {"conv_id": to_arrow_type(own), **dict.fromkeys(counts, pa.int64()), "audit": pa.string(),
             "repaired_sha256": pa.string()}
    return merged.mapInArrow(_digests(arrow), f"conv_id {own.simpleString()}, " + ", ".join(f"{c} long" for c in counts)
                             + ", audit string, repaired_sha256 string")


def _repaired(types: dict[str, pa.DataType]):
    def run(batches):
        out = []

        def repaired(conv, rows):
            for role, text, edit, turn in rows:
                out.append((conv.conv_id, conv.position, turn, role.decode(), text.decode(), edit))
                conv.position += 1
        for _ in _walk(batches, lambda conv: None, repaired):
            if out:
                rows, out[:] = list(out), []
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types.values(), strict=True)],
                    names=list(types))
    return run


def repair(rows: DataFrame, chunk_rows: int = 128, passes: int = 4) -> DataFrame:
    """The repaired conversations: conv_id, position (from 0), turn (null for
    inserted rows), role, text and edit (K kept, R new role, I inserted).  Rows are
    read as ``audit`` reads them; conversations that lose every row give none."""
    merged = _merged(rows, rows, chunk_rows, passes)
    kinds = {c: merged.schema[c].dataType for c in ("conv_id", "turn")}
    arrow = {"conv_id": to_arrow_type(kinds["conv_id"]), "position": pa.int64(), "turn": to_arrow_type(kinds["turn"]),
             "role": pa.string(), "text": pa.string(), "edit": pa.string()}
    return merged.mapInArrow(_repaired(arrow), "conv_id {conv_id}, position long, turn {turn}, role string, text string, "
                             "edit string".format(**{c: t.simpleString() for c, t in kinds.items()}))
