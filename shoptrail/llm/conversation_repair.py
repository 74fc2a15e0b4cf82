"""Conversation structure repair (operator 11): the cheapest edits that give a
conversation the role initials ``(s?(ua)+)?``, by an integer-minimum dynamic
program over scalar big-integer weights.

A path through a conversation edits each row in turn: K keeps it, R reroles it
to user or assistant, D deletes it, I inserts an empty row before it (or at the
end). A row's edit is one field of two letters, ``D`` ``ID`` ``IK`` ``IR`` ``K``
``R``, padded at its end with zero; no field begins another one, so paths
compare like their strings. An edge weighs ``cost * 64**rows + field * 64**(rows
after it)``: high digits carry the cost, low digits the letters at their
place, and the plain integer minimum is the cheapest path of least string. Two
inserts never stand side by side on a cheapest path, as leaving out both is
valid and cheaper.

The order (turn, nulls first, then role and a text hash) is cut into blocks of
``BLOCK`` rows, so that a long conversation is nowhere whole in a task:

1. Narrow rows (role, 128-bit text hash, faults) are range-partitioned in that
   order; a conversation may lie in many partitions. Repeats are found by the
   first place of each (conversation, role, text).
2. Each block's program gives its least weight from each of the four states
   (nothing yet, s, u, a) to each.
3. Blocks are walked backwards: a state's rest is its cost and its rank among
   the four, which decides ties between blocks without the letters.
4. Texts are shuffled once, in the same order, and streamed past the decisions.

Defined cases: nulls read as one space in role and text; a null conv_id is a
conversation of its own; rows of equal turn, role and text are interchangeable
repeats; rows of equal turn go by role, then by text hash; other roles are kept
only where their first letter is s, u or a in its place. An empty table gives
an empty result. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections import Counter, deque
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shoptrail.llm.tables import stage, text_batches

BLOCK = 256
PARTITION_ROWS = 200_000
NONE, SYSTEM, USER, ASSISTANT = range(4)  # the states: the initial that came last
FIELDS = {"D": 0o10, "ID": 0o21, "IK": 0o23, "IR": 0o24, "K": 0o30, "R": 0o40}  # letters as octal digits D I K R = 1 2 3 4
NAMES = {v: k for k, v in FIELDS.items()}
KEEP, REROLE, DELETE, INSERT, CUT = 0, 1, 2, 5, 5
TAIL = {NONE: 0, ASSISTANT: 0, USER: INSERT}  # cost of ending in a state; USER needs an inserted assistant
BLANK = r"\x20\x09-\x0D"

FAULTS = ["", "blank", "duplicate", "truncated"]


def _next(state: int) -> int:
    return ASSISTANT if state == USER else USER


def _kept(state: int, initial: str) -> int | None:
    """The state after a kept row, if it may stand there."""
    if initial == "s":
        return SYSTEM if state == NONE else None
    return _next(state) if initial == ("a" if state == USER else "u") else None


def _moves(initial: str, fault: int) -> list[list[tuple[int, int, int]]]:
    """For each state: (state after, cost, field) of every edit of a row."""
    out = []
    for state in range(4):
        moves = []
        for before, paid, letter in ((state, 0, ""), (_next(state), INSERT, "I")):
            moves.append((before, paid + DELETE, FIELDS[letter + "D"]))
            if fault not in (1, 2):
                late = CUT if fault == 3 else 0
                kept = _kept(before, initial)
                if kept is not None:
                    moves.append((kept, paid + KEEP + late, FIELDS[letter + "K"]))
                moves.append((_next(before), paid + REROLE + late, FIELDS[letter + "R"]))
        out.append(moves)
    return out


MOVES = {(i, f): _moves(i, f) for i in "sua-" for f in range(4)}


def block_weights(initials: str, faults: bytes) -> list[list[int | None]]:
    """least[s][t]: the least weight of a path from state s to state t over
    the rows; None where no path leads."""
    n = len(initials)
    high = 6 * n
    least: list[list[int | None]] = [[0 if s == t else None for t in range(4)] for s in range(4)]
    for i in range(n - 1, -1, -1):  # the rest of the block is known
        place = 6 * (n - 1 - i)
        moves = MOVES[initials[i], faults[i]]
        now: list[list[int | None]] = []
        for s in range(4):
            row: list[int | None] = [None] * 4
            for after, cost, field in moves[s]:
                edge = (cost << high) + (field << place)
                for t, rest in enumerate(least[after]):
                    if rest is not None and (row[t] is None or edge + rest < row[t]):
                        row[t] = edge + rest
            now.append(row)
        least = now
    return least


def fields_of(weight: int, n: int) -> list[str]:
    """The edits of a path over n rows."""
    return [NAMES[(weight >> 6 * (n - 1 - i)) & 0o77] for i in range(n)]


def _programs(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Every block's least weights: the costs, and the letters as bytes."""
    for pdf in frames:
        costs, letters = [], []
        for initials, faults in zip(pdf["initials"], pdf["faults"]):
            n = len(initials)
            mask, size = (1 << 6 * n) - 1, (6 * n + 7) // 8
            flat = [w for row in block_weights(initials, bytes(map(int, faults))) for w in row]
            costs.append([-1 if w is None else w >> 6 * n for w in flat])
            letters.append([b"" if w is None else (w & mask).to_bytes(size, "big") for w in flat])
        yield pdf[["conv", "seg", "block", "turn", "role", "hash", "faults"]].assign(costs=costs, letters=letters)


def _walk_back(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """From a conversation's last block to its first: for each state the best
    way through the block, given the rests behind it. A rest is (cost, rank of
    its letters among the four states)."""
    conv, rest = _Nobody, None
    for pdf in frames:
        out = []
        for c, costs, letters in zip(pdf["conv"], pdf["costs"], pdf["letters"]):
            if c != conv:
                conv = c
                rest = [(TAIL[s], int(s == USER)) if s in TAIL else None for s in range(4)]
            ways = []
            for s in range(4):
                known = [(int(costs[4 * s + t]) + rest[t][0], bytes(letters[4 * s + t]), rest[t][1], t)
                         for t in range(4) if rest[t] is not None and costs[4 * s + t] >= 0]
                ways.append(min(known) if known else None)
            order = sorted({w[1:3] for w in ways if w})
            rest = [(w[0], order.index(w[1:3])) if w else None for w in ways]
            out.append(([w[3] if w else -1 for w in ways], [w[1] if w else b"" for w in ways]))
        yield pdf[["conv", "turn", "role", "hash", "faults"]].assign(to=[o[0] for o in out], letters=[o[1] for o in out])


_Nobody = object()
REPAIRED = ["conv", "turn", "fault", "edit", "edit_cost", "old_role", "role", "text", "last"]
REPAIRED_TYPES = ("conv string, turn string, fault string, edit string, edit_cost int, old_role string, role string, text string, "
                  "last boolean")


def _stream(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row an edit, in order. A block's decisions stand before its rows;
    rows take their edits from the queue of decisions."""
    conv, state, plan, queue = _Nobody, NONE, NONE, deque()

    def ending() -> tuple:
        insert = state == USER
        return (conv, None, "", "I" if insert else "", INSERT if insert else 0, None, "assistant" if insert else None, "", True)
    for pdf in frames:
        out = []
        for c, turn, role, text, faults, to, letters in zip(
                pdf["conv"], pdf["turn"], pdf["role"], pdf["text"], pdf["faults"], pdf["to"], pdf["letters"]):
            if conv is _Nobody or c != conv:
                if conv is not _Nobody:
                    out.append(ending())
                conv, state, plan = c, NONE, NONE
                queue.clear()
            if faults is not None:  # a block's decisions
                queue.extend(zip(fields_of(int.from_bytes(bytes(letters[plan]), "big"), len(faults)), map(int, faults)))
                plan = int(to[plan])
                continue
            edit, fault = queue.popleft()
            if edit[0] == "I":
                state = _next(state)
                out.append((c, turn, "", "I", INSERT, None, "user" if state == USER else "assistant", "", False))
            late = CUT if fault == 3 else 0
            if edit[-1] == "D":
                out.append((c, turn, FAULTS[fault], "D", DELETE, role, None, text, False))
            elif edit[-1] == "K":
                state = _kept(state, role[:1])
                out.append((c, turn, FAULTS[fault], "K", KEEP + late, role, role, text, False))
            else:
                state = _next(state)
                out.append((c, turn, FAULTS[fault], "R", REROLE + late, role, "user" if state == USER else "assistant", text, False))
        yield pd.DataFrame(out, columns=REPAIRED)
    if conv is not _Nobody:
        yield pd.DataFrame([ending()], columns=REPAIRED)


def _faulty(places: DataFrame) -> DataFrame:
    """Adds ``fault`` (place in FAULTS) and the initial (- if no s, u, a)."""
    firsts = places.groupBy(F.col("conv").alias("c"), F.col("role").alias("r"), F.col("hash").alias("h")).agg(
        F.min(F.struct("seg", "pos")).alias("at"))
    same = places["conv"].eqNullSafe(firsts["c"]) & (places["role"] == firsts["r"]) & (places["hash"] == firsts["h"])
    fault = F.when(F.col("blank"), 1).when(F.struct("seg", "pos") > F.col("at"), 2).when(F.col("cut"), 3).otherwise(0)
    initial = F.substring("role", 1, 1)
    return places.join(firsts, same).select("conv", "turn", "role", "hash", "seg", "pos", fault.cast("string").alias("fault"),
                                            F.when(initial.isin("s", "u", "a"), initial).otherwise("-").alias("initial"))


def _edits(rows: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str, block: int) -> DataFrame:
    spark = rows.sparkSession
    text_batches(spark)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(" "))
    ready = rows.select(F.col(conv_col).cast("string").alias("conv"), F.col(turn_col).cast("long").alias("turn"),
                        F.coalesce(F.col(role_col).cast("string"), F.lit(" ")).alias("role"), text.alias("text"), F.md5(text).alias("hash"))
    order = ["conv", "turn", "role", "hash"]
    narrow = ready.select(*order, (~F.col("text").rlike(f"[^{BLANK}]")).alias("blank"),
                          (~F.col("text").rlike(f"[.!?][{BLANK}]*\\z")).alias("cut"))
    partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // PARTITION_ROWS))
    ranged = stage(narrow.repartitionByRange(partitions, *order).withColumn("seg", F.spark_partition_id()), "turns")
    inside = Window.partitionBy("conv", "seg").orderBy("turn", "role", "hash")
    places = _faulty(ranged.withColumn("pos", F.row_number().over(inside) - 1))

    row = F.struct("pos", "turn", "role", "hash", "initial", "fault")
    blocks = (places.groupBy("conv", "seg", F.floor(F.col("pos") / block).alias("block"))
              .agg(F.sort_array(F.collect_list(row)).alias("rows"))
              .select("conv", "seg", "block", F.col("rows")[0]["turn"].cast("string").alias("turn"), F.col("rows")[0]["role"].alias("role"),
                      F.col("rows")[0]["hash"].alias("hash"), F.array_join("rows.initial", "").alias("initials"),
                      F.array_join("rows.fault", "").alias("faults")))
    key = "conv string, seg int, block long, turn string, role string, hash string, faults string"
    solved = blocks.mapInPandas(_programs, f"{key}, costs array<long>, letters array<binary>")
    plans = (solved.repartition(partitions, "conv").sortWithinPartitions("conv", F.desc("seg"), F.desc("block"))
             .mapInPandas(_walk_back, "conv string, turn string, role string, hash string, faults string, to array<int>, letters array<binary>"))
    both = (plans.select("conv", F.col("turn").cast("long").alias("turn"), "role", "hash", F.lit(0).alias("kind"),
                         F.lit(None).cast("string").alias("text"), "faults", "to", "letters")
            .unionByName(ready.withColumn("kind", F.lit(1)), allowMissingColumns=True))
    return (both.repartition(partitions, "conv").sortWithinPartitions("conv", "turn", "role", "hash", "kind")
            .select("conv", F.col("turn").cast("string").alias("turn"), "role", "text", "faults", "to", "letters")
            .mapInPandas(_stream, REPAIRED_TYPES))


def repair(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """The edits of every conversation, in order within a partition: conv,
    turn, fault, edit (K R D I), edit_cost, old_role, role (null if deleted),
    text; the rows that are not deleted are the repaired conversation."""
    made = _edits(rows, conv_col, turn_col, role_col, text_col, block).where("not last or edit = 'I'").drop("last")
    return made.withColumn("conv", F.col("conv").cast(rows.schema[conv_col].dataType)).withColumn("turn", F.col("turn").cast("long"))


DIGEST = ["conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
DIGEST_TYPES = ("conv string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
                "repaired_sha256 string")
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()


def _digest(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row a conversation, from its edits as they stream by: the texts go
    into the running hash, only the audit letters are kept."""
    sha, audit, counts = hashlib.sha256(), [], Counter()
    lowest = previous = initial = None
    started = False
    for pdf in frames:
        out = []
        for c, turn, fault, edit, cost, old, role, text, last in zip(*(pdf[x] for x in REPAIRED)):
            if edit:
                audit.append(edit)
                counts["cost"] += int(cost)
                if role is not None:
                    sha.update((f"\n{role}:{text}" if started else f"{role}:{text}").encode("utf-8", "surrogatepass")
                               if edit != "I" else (f"\n{role}:" if started else f"{role}:").encode())
                    started = True
            if old is not None:
                counts[fault] += 1
                if initial is not None and initial + old[:1] not in ("su", "ua", "au"):
                    counts["illegal"] += 1
                initial = old[:1]
                if turn is not None and (previous is None or int(turn) != previous):
                    previous = int(turn)
                    lowest = previous if lowest is None else lowest
                    counts["turns"] += 1
            if last:
                gaps = 0 if lowest is None else previous - lowest + 1 - counts["turns"]
                out.append((c, gaps, counts["blank"], counts["duplicate"], counts["truncated"], counts["illegal"], counts["cost"],
                            "".join(audit), sha.hexdigest()))
                sha, audit, counts = hashlib.sha256(), [], Counter()
                lowest = previous = initial = None
                started = False
        yield pd.DataFrame(out, columns=DIGEST)


def damage(rows: DataFrame) -> DataFrame:
    """The contract's damaged conversations, by crc32 of ``conv_id:turn``."""
    def text(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.pmod(F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn"))), F.lit(20))
    hurt = rows.select("conv_id", "turn", text("role").alias("role"), text("text").alias("text"), kind.alias("kind")).where("kind <> 0")
    return hurt.select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.array_repeat(F.lit(0), F.when(F.col("kind") == 3, 2).otherwise(1))).alias("copy")).drop("copy")


def repair_damaged(conversations: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row an original conv_id: faults, cost, audit letters and the hash
    of the repaired conversation after ``damage``."""
    digests = _edits(damage(conversations), "conv_id", "turn", "role", "text", block).mapInPandas(_digest, DIGEST_TYPES)
    every = conversations.select("conv_id").distinct()
    joined = every.join(digests, F.col("conv_id").cast("string").eqNullSafe(F.col("conv")), "left")
    return joined.select("conv_id", *[F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in DIGEST[1:7]],
                         F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(EMPTY_SHA256)).alias("repaired_sha256"))
