"""Conversation structure repair: the cheapest edits that make turns alternate, by a checkpointed dynamic program.

After its rows are judged, a conversation is a sequence of codes, and the state of a repaired one is what its last role was:
nothing, system, user or assistant. A backward pass gives the cost of the rest from every state before every row. The vectors
of four costs are kept only at checkpoints about a square root of a block apart; the forward walk makes the vectors of one
stretch between checkpoints again and takes the ASCII-least edit among those that stay on the cheapest way. Every edit's letter
leads to one state, so the least letters one by one are the least string.

A conversation of any length is dealt out in blocks of BLOCK rows, by a range-partitioned sort: a block's rows are a 4 by 4
matrix of costs (min-plus), a stream over a conversation's matrices from the last gives the vector behind each block, and a
block walks from all four states at once; a second stream picks the walk of the state that the block before ends in. Only
the digest of the repaired texts is one sequence by contract: it reads a conversation's rows in order, holding one at a time.

Rows that are equal in conversation, turn, role and text are one row with a count; the first of them may stand, the others
are duplicates. Where a role and text were said before in the conversation is asked with one minimum a (conversation, role,
text), combined before the shuffle.

Defined results: null role and text are one space, as are null ids in the checksum's key; rows with a null conv_id are one
conversation; null turns come first; rows of one turn are in the order of role and text; repeated rows are rows of their own;
very long texts count whole; conversations without rows after damage have zeros and an empty audit; an empty table gives an
empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from math import isqrt

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import by_bytes, keep

BLOCK_BITS = 12  # rows of a block: 4096
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3  # costs
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
NEXT = (USER, USER, ASSISTANT, USER)  # the state that a role put in, or put right, leads to
ENDS = (0, 2 * INSERT, INSERT, 0)  # cost of the rest behind the last row
FAR = 1 << 60
CLASSES = "xsua"  # of the roles' initials; a code is 3 * class + fault
FINE, CUT, GONE = range(3)
_BLANK, _LAST_MARK = r"^[\x20\x09-\x0D]*\z", r"[.!?][\x20\x09-\x0D]*\z"


def _allowed(state: int, code: int) -> int | None:
    """The state behind a row that stays as it is; None where it may not."""
    if code // 3 == 1 and state == NOTHING:
        return SYSTEM
    return NEXT[state] if code // 3 == NEXT[state] else None


STAYS = [[_allowed(state, code) for state in range(4)] for code in range(12)]


def _with_inserts(v: list[int]) -> list[int]:
    """Costs of the rest when inserts may come first; two in a row are the most that a cheapest way has."""
    for _ in range(2):
        v = [min(v[s], INSERT + v[NEXT[s]]) for s in range(4)]
    return v


def before_row(v: list[int], code: int, n: int) -> list[int]:
    """Costs of the rest before n equal rows from those behind them; of rows that go, any number costs DELETE each."""
    if code % 3 == GONE:
        return [x + DELETE * n for x in v]
    more = TRUNCATED * (code % 3 == CUT)
    return _with_inserts([min(DELETE + v[s], REROLE + more + v[NEXT[s]], FAR if STAYS[code][s] is None else KEEP + more + v[STAYS[code][s]]) for s in range(4)])


def matrix(codes: list[int], counts: list[int]) -> list[int]:
    """Costs from every state before a block to every state behind it, 16 numbers."""
    out = []
    for end in range(4):
        v = _with_inserts([0 if s == end else FAR for s in range(4)])
        for code, n in zip(reversed(codes), reversed(counts)):
            v = before_row(v, code, n)
        out.append(v)
    return [out[end][start] for start in range(4) for end in range(4)]


def behind_checkpoints(codes: list[int], counts: list[int], end: list[int]) -> tuple[int, list[list[int]]]:
    """(rows between checkpoints, the vectors behind each such stretch), from one backward pass that keeps no others."""
    width = max(1, isqrt(len(codes)))
    last, v, out = (len(codes) - 1) // width, end, []
    for at in range(last, -1, -1):
        out.append(v)
        for i in range(min(len(codes), (at + 1) * width) - 1, at * width - 1, -1):
            v = before_row(v, codes[i], counts[i])
    return width, out[::-1]


def walk(codes: list[int], counts: list[int], width: int, behind: list[list[int]], state: int, is_last: bool) -> tuple[str, int]:
    """(edits, state behind them) of a block from one state: the ASCII-least among the cheapest."""
    out = []
    for at, v in enumerate(behind):
        rows = range(at * width, min(len(codes), (at + 1) * width))
        vectors = [v]
        for i in reversed(rows):
            vectors.append(before_row(vectors[-1], codes[i], counts[i]))
        for i in rows:
            here, after, code = vectors.pop(), vectors[-1], codes[i]
            if code % 3 == GONE:
                out.append("D" * counts[i])
                continue
            more, stays = TRUNCATED * (code % 3 == CUT), STAYS[code]
            while True:
                left = here[state]
                if left == DELETE + after[state]:
                    out.append("D")
                elif left == INSERT + here[NEXT[state]]:
                    out.append("I")
                    state = NEXT[state]
                    continue
                elif stays[state] is not None and left == KEEP + more + after[stays[state]]:
                    out.append("K")
                    state = stays[state]
                else:
                    out.append("R")
                    state = NEXT[state]
                break
    while is_last and ENDS[state]:
        out.append("I")
        state = NEXT[state]
    return "".join(out), state


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, n): the contract's damage, equal rows as one with their number."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), space("role").alias("role"), space("text").alias("text"))
    kind = F.crc32(F.concat_ws(":", space("conv_id"), space("turn")).cast("binary")) % 20
    text = F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    hurt = rows.withColumn("kind", kind).where("kind != 0").select("conv_id", "turn", F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"), text.alias("text"), F.when(F.col("kind") == 3, 2).otherwise(1).alias("n"))
    return hurt.groupBy("conv_id", "turn", "role", "text").agg(F.sum("n").alias("n"))


def _class(role: Column) -> Column:
    return F.coalesce(*[F.when(F.left(role, F.lit(1)) == c, F.lit(k)) for k, c in enumerate(CLASSES) if k], F.lit(0))


def judged(rows: DataFrame) -> DataFrame:
    """(conv_id, at, turn, role, text, n, blank, duplicate, cut): distinct rows in their order, which `at` keeps.

    blank, duplicate and cut count the rows under a row's number whose first fault it is; at's upper bits are a block.
    """
    said = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    with_key = rows.withColumns({"said": said, "blank": F.when(F.col("text").rlike(_BLANK), F.col("n")).otherwise(0)})
    first = with_key.groupBy("conv_id", "said").agg(F.min(F.struct(F.col("turn").isNotNull().alias("late"), "turn")).alias("first"))
    same = first.select(F.col("conv_id").alias("_conv"), F.col("said").alias("_said"), F.col("first.turn").alias("_turn"))
    joined = with_key.join(same, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("said") == F.col("_said")))
    again = F.when(F.col("blank") > 0, 0).when(F.col("turn").eqNullSafe(F.col("_turn")), F.col("n") - 1).otherwise(F.col("n"))
    counted = joined.withColumn("duplicate", again)
    counted = counted.withColumn("cut", F.when((F.col("blank") == 0) & (F.col("duplicate") < F.col("n")) & ~F.col("text").rlike(_LAST_MARK), 1).otherwise(0))
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["conv_id", F.asc_nulls_first("turn"), "role", "text"]
    placed = counted.select("conv_id", "turn", "role", "text", "n", "blank", "duplicate", "cut").repartitionByRange(parts, *order).sortWithinPartitions(*order)
    return keep(placed.withColumn("at", F.monotonically_increasing_id()))


def _runs() -> Column:
    """A row's (code, count) pairs: what may stand, then what goes."""
    kind, gone = _class(F.col("role")) * 3, F.col("blank") + F.col("duplicate")
    stands = F.struct((kind + F.when(F.col("cut") > 0, CUT).otherwise(FINE)).cast("int").alias("code"), F.lit(1).cast("long").alias("n"))
    goes = F.struct((kind + GONE).cast("int").alias("code"), gone.cast("long").alias("n"))
    return F.when(gone == 0, F.array(stands)).when(gone == F.col("n"), F.array(goes)).otherwise(F.array(stands, goes))


def _illegal(rows: Column) -> Column:
    """Neighbours within a block whose roles may not follow each other; a row's own copies are such."""
    pair = lambda x, y: F.when(F.concat(x["c"], y["c"]).isin("su", "ua", "au"), 0).otherwise(1)
    between = F.zip_with(F.slice(rows, 1, F.size(rows) - 1), F.slice(rows, 2, F.size(rows)), pair)
    return F.aggregate(between, F.lit(0).cast("long"), lambda a, x: a + x) + F.aggregate(rows, F.lit(0).cast("long"), lambda a, x: a + x["n"] - 1)


def _blocks(rows: DataFrame) -> DataFrame:
    """(conv_id, block, codes, counts, first, last, illegal), from the columns without texts."""
    initial = F.element_at(F.split(F.lit(",".join(CLASSES)), ","), _class(F.col("role")) + 1)
    one = F.struct("at", "n", initial.alias("c"), _runs().alias("runs"))
    gathered = rows.groupBy("conv_id", F.shiftright("at", BLOCK_BITS).alias("block")).agg(F.sort_array(F.collect_list(one)).alias("rows"))
    runs = F.flatten(F.transform("rows", lambda x: x["runs"]))
    return gathered.select("conv_id", "block", F.transform(runs, lambda x: x["code"]).alias("codes"), F.transform(runs, lambda x: x["n"]).alias("counts"), F.element_at("rows", 1)["c"].alias("first"), F.element_at("rows", -1)["c"].alias("last"), _illegal(F.col("rows")).alias("illegal"))


def _matrices(blocks: DataFrame) -> DataFrame:
    def run(batches):
        for batch in batches:
            out = [matrix(codes, counts) for codes, counts in zip(batch.column("codes").to_pylist(), batch.column("counts").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("conv_id"), batch.column("block"), pa.array(out, pa.list_(pa.int64()))], ["conv_id", "block", "costs"])

    return blocks.select("conv_id", "block", "codes", "counts").mapInArrow(run, "conv_id long, block long, costs array<long>")


def _ends(matrices: DataFrame) -> DataFrame:
    """(conv_id, block, behind, is_last, cost): the vector behind each block; cost is that from the block's beginning and no role."""

    def run(batches):
        conv, v = object(), None
        for batch in batches:
            out = []
            for c, costs in zip(batch.column("conv_id").to_pylist(), batch.column("costs").to_pylist()):
                is_last = c != conv
                if is_last:
                    conv, v = c, list(ENDS)
                before = [min(costs[4 * start + end] + v[end] for end in range(4)) for start in range(4)]
                out.append((v, is_last, before[NOTHING]))
                v = before
            yield pa.RecordBatch.from_arrays([batch.column("conv_id"), batch.column("block"), pa.array([x[0] for x in out], pa.list_(pa.int64())), pa.array([x[1] for x in out], pa.bool_()), pa.array([x[2] for x in out], pa.int64())],
                                             ["conv_id", "block", "behind", "is_last", "cost"])

    from_last = matrices.repartition("conv_id").sortWithinPartitions("conv_id", F.desc("block"))
    return from_last.mapInArrow(run, "conv_id long, block long, behind array<long>, is_last boolean, cost long")


def _walks(blocks: DataFrame) -> DataFrame:
    """(conv_id, block, audits, states): a block's edits and last state from each of the four states."""

    def run(batches):
        for batch in batches:
            audits, states = [], []
            for codes, counts, behind, is_last in zip(*(batch.column(c).to_pylist() for c in ("codes", "counts", "behind", "is_last"))):
                kept = behind_checkpoints(codes, counts, behind)
                ways = [walk(codes, counts, *kept, state, is_last) for state in range(4)]
                audits.append([w[0] for w in ways])
                states.append([w[1] for w in ways])
            yield pa.RecordBatch.from_arrays([batch.column("conv_id"), batch.column("block"), pa.array(audits, pa.list_(pa.string())), pa.array(states, pa.list_(pa.int32()))], ["conv_id", "block", "audits", "states"])

    return blocks.select("conv_id", "block", "codes", "counts", "behind", "is_last").mapInArrow(run, "conv_id long, block long, audits array<string>, states array<int>")


def _chosen(walks: DataFrame) -> DataFrame:
    """(conv_id, block, audit): of each block the edits from the state in which the block before ends."""

    def run(batches):
        conv, state = object(), NOTHING
        for batch in batches:
            out = []
            for c, audits, states in zip(*(batch.column(x).to_pylist() for x in ("conv_id", "audits", "states"))):
                if c != conv:
                    conv, state = c, NOTHING
                out.append(audits[state])
                state = states[state]
            yield pa.RecordBatch.from_arrays([batch.column("conv_id"), batch.column("block"), pa.array(out, pa.string())], ["conv_id", "block", "audit"])

    return walks.repartition("conv_id").sortWithinPartitions("conv_id", "block").mapInArrow(run, "conv_id long, block long, audit string")


def edits(rows: DataFrame) -> DataFrame:
    """(conv_id, block, audit, illegal, cost) of judged() rows: the cheapest edits by block; cost is the conversation's, in its first block."""
    blocks = keep(_blocks(rows))
    ends = keep(_ends(_matrices(blocks)))
    same = lambda df: df.withColumnsRenamed({"conv_id": "_conv", "block": "_block"})
    on = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("block") == F.col("_block"))
    walks = _walks(by_bytes(blocks.join(same(ends), on)))
    chosen = _chosen(walks)
    lined = Window.partitionBy("conv_id").orderBy("block")
    met = F.concat(F.lag("last").over(lined), F.col("first"))
    illegal = F.col("illegal") + F.when(met.isin("su", "ua", "au"), 0).when(met.isNotNull(), 1).otherwise(0)
    small = blocks.select("conv_id", "block", "first", "last", "illegal").join(same(ends.select("conv_id", "block", "cost")), on).select("conv_id", "block", illegal.alias("illegal"), F.when(F.row_number().over(lined) == 1, F.col("cost")).otherwise(0).alias("cost"))
    return keep(chosen.join(same(small), on).select("conv_id", "block", "audit", "illegal", "cost"))


def repaired(rows: DataFrame, found: DataFrame) -> DataFrame:
    """(conv_id, at, n, role, text, audit): what edits() makes of judged() rows is read with repaired_turns().

    The edits of a block come before its rows, under the same order.
    """
    # a block's inserts may come before its first row, so its edits stand at its first place
    heads = found.select("conv_id", F.shiftleft("block", BLOCK_BITS).alias("at"), F.lit(0).alias("after"), F.lit(0).cast("long").alias("n"), F.lit("").alias("role"), F.lit("").alias("text"), "audit")
    body = rows.select("conv_id", "at", F.lit(1).alias("after"), "n", "role", "text", F.lit(None).cast("string").alias("audit"))
    return heads.unionByName(body).repartition("conv_id").sortWithinPartitions("conv_id", "at", "after").drop("after")


class _Turns:
    """Turns of a conversation as its edits leave them, row by row."""

    def __init__(self):
        self.audit, self.place, self.state = "", 0, NOTHING

    def _role(self) -> str:
        self.state = NEXT[self.state]
        return "user" if self.state == USER else "assistant"

    def inserts(self):
        while self.place < len(self.audit) and self.audit[self.place] == "I":
            self.place += 1
            yield self._role(), ""

    def start(self, audit: str):
        """The edits of a further block; what the last one has left are inserts."""
        yield from self.inserts()
        self.audit, self.place = audit, 0

    def row(self, role: str, text: str, n: int):
        for _ in range(n):
            yield from self.inserts()
            edit = self.audit[self.place]
            self.place += 1
            if edit == "K":
                self.state = SYSTEM if role[:1] == "s" and self.state == NOTHING else NEXT[self.state]
                yield role, text
            elif edit == "R":
                yield self._role(), text


def digests(turns: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256) of repaired() rows: a stream that holds one row and one block's edits."""

    def run(batches):
        conv, turns_of, digest, empty = object(), None, None, True
        done: list = []

        def add(said):
            nonlocal empty
            for role, text in said:
                digest.update((("" if empty else "\n") + f"{role}:{text}").encode())
                empty = False

        def finish():
            add(turns_of.inserts())
            done.append((conv, digest.hexdigest()))

        def out():
            rows, done[:] = list(done), []
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.string())], ["conv_id", "repaired_sha256"])

        for batch in batches:
            for c, n, role, text, audit in zip(*(batch.column(x).to_pylist() for x in ("conv_id", "n", "role", "text", "audit"))):
                if c != conv or turns_of is None:
                    if turns_of is not None:
                        finish()
                    conv, turns_of, digest, empty = c, _Turns(), hashlib.sha256(), True
                add(turns_of.start(audit) if audit is not None else turns_of.row(role, text, n))
            yield out()
        if turns_of is not None:
            finish()
            yield out()

    return by_bytes(turns).select("conv_id", "n", "role", "text", "audit").mapInArrow(run, "conv_id long, repaired_sha256 string")


def structure_repair(conversations: DataFrame) -> DataFrame:
    """The contract's digest of every original conversation."""
    rows = judged(damaged(conversations))
    found = edits(rows)
    n_turns = F.count_distinct("turn")
    counts = rows.groupBy("conv_id").agg(F.coalesce(F.max("turn") - F.min("turn") + 1 - n_turns, F.lit(0).cast("long")).alias("gaps"), *[F.sum(c).alias(name) for c, name in (("blank", "blank"), ("duplicate", "duplicate"), ("cut", "truncated"))])
    audits = found.groupBy("conv_id").agg(F.sum("illegal").alias("illegal"), F.sum("cost").alias("cost"), F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("block", "audit"))), lambda x: x["audit"]), "").alias("audit"))
    out = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    for table in (counts, audits, digests(repaired(rows, found))):
        other = table.withColumnRenamed("conv_id", "_conv")
        out = out.join(other, F.col("conv_id").eqNullSafe(F.col("_conv")), "left").drop("_conv")
    zeros = [F.coalesce(F.col(c).cast("long"), F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select("conv_id", *zeros, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))
