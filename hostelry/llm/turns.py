"""Conversation structure repair by target alignment (operator 11).

A repaired conversation's role initials are ``(s?(ua)+)?``, so their number alone
says which they are: an odd one begins with the system turn. A conversation's turns are aligned
to the grammar's string of each feasible length by Wagner and Fischer's table of
least costs, here of what is still to pay. Ukkonen's bands leave out the cells that
cost more than the incumbent, the best alignment of the lengths tried so
far; lengths are tried from the likeliest on, and the incumbent also ends them. The audit is
traced back through the table by its least letter, and audits of equal cost are compared.

Costs: keep 0, rerole to user or assistant 3, delete 4 (blank and duplicate turns must go),
insert an empty user or assistant turn 3; a truncated turn that stays 3 more.

Long conversations: every ``CHUNK`` turns are aligned from each state that the grammar can be in
before them (nothing yet, after system, user, assistant) to each it can be in after
them. Of two equally dear audits of a chunk between the same states none begins the other, so the least
audit of the whole is made of least audits of its parts; parts are joined
pairwise. Turns are range-partitioned by conversation and turn: a conversation with a third of
all rows spreads over many tasks, each of which sends on one part and its turns. The digest of a
repaired conversation is one pass over its turns, in order and by batches, so it is the
only step that one task does for one conversation, in memory that holds the audit alone.

Equal rows of one turn are counted before they move. Whether role and text came earlier is
known from the first turn of each (conversation, role, digest of the text).

Edge cases: null roles and texts, and in the hashed key null ids and turns, are one space. Null turns come first,
null conversation ids are one conversation. Rows of equal turn are ordered by role, then by the SHA-256 of
the text. A role other than system, user and assistant is kept only if it has the wanted initial. A conversation that lost all rows has zeros, an empty audit
and the empty string's hash. Texts may be of any length: one is held at a time beyond
``HELD`` bytes of a conversation. Extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hostelry.llm.common import materialize, only, partitions, release_memory

REROLE, DELETE, INSERT, CUT = 3, 4, 3, 3
#: Turns aligned at once.
CHUNK = 32
#: Bytes of a conversation held in a task; a larger one goes the way of those that several tasks share.
HELD = 4 << 20
#: States of the grammar: nothing yet, after system, after user, after assistant. A conversation may end in the first and the last.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
_NONE = 1 << 60
_SPACE = b" \t\n\x0b\x0c\r"
RESULT = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]

Best = tuple[int, str] | None


def align(codes: str, target: str, bound: int) -> Best:
    """(cost, audit) of the cheapest edits that make ``target`` of the turns, the least
    audit among them; None beyond ``bound``. codes: a turn's role initial, in upper
    case if it is truncated, ``d`` if it must go, ``x`` for other roles."""
    m, n = len(codes), len(target)
    free = [0]
    for c in codes:
        free.append(free[-1] + (c != "d"))
    slack, gap = bound - DELETE * (m - free[m]), n - free[m]
    # inserts less deletions so far, which cells within the bound can have
    band = [d for d in range(-free[m], n + 1) if _off(d) + _off(gap - d) <= slack]
    if not band:
        return None
    low, high = band[0], band[-1]
    table: list[dict[int, int]] = [{} for _ in range(m + 1)]
    for i in range(m, -1, -1):
        row, below = table[i], table[i + 1] if i < m else {}
        for j in range(min(n, free[i] + high), max(0, free[i] + low) - 1, -1):
            if i == m and j == n:
                row[j] = 0
                continue
            row[j] = min((cost + to for _, cost, to, _, _ in _edits(codes, target, i, j, row, below)), default=_NONE)
    total = table[0].get(0, _NONE)
    if total > bound:
        return None
    audit, i, j = [], 0, 0
    while i < m or j < n:
        here = table[i][j]
        letter, i, j = min((e, a, b) for e, cost, to, a, b in _edits(codes, target, i, j, table[i], table[i + 1] if i < m else {}) if cost + to == here)
        audit.append(letter)
    return total, "".join(audit)


def _off(d: int) -> int:
    return INSERT * d if d > 0 else -DELETE * d


def _edits(codes: str, target: str, i: int, j: int, row: dict[int, int], below: dict[int, int]) -> Iterator[tuple[str, int, int, int, int]]:
    """(letter, cost, what is then still to pay, turn, place) of the edits at turn i and place j."""
    wanted = target[j] if j < len(target) else ""
    if i < len(codes):
        code = codes[i]
        yield "D", DELETE, below.get(j, _NONE), i + 1, j
        if code != "d" and wanted:
            cut = CUT if code.isupper() else 0
            if code.lower() == wanted:
                yield "K", cut, below.get(j + 1, _NONE), i + 1, j + 1
            elif wanted != "s":
                yield "R", cut + REROLE, below.get(j + 1, _NONE), i + 1, j + 1
    if wanted in ("u", "a"):
        yield "I", INSERT, row.get(j + 1, _NONE), i, j + 1


def targets(entry: int, leave: int, most: int) -> Iterator[str]:
    """Strings of at most ``most`` initials that lead from one state to the other."""
    if entry == leave:
        yield ""
    begins = {NOTHING: ("u", "s"), SYSTEM: ("u",), USER: ("a",), ASSISTANT: ("u",)}[entry]
    for first in begins:
        after = "au" if first == "u" else "ua"
        for n in range(1, most + 1):
            text = (first + after * n)[:n]
            if {"s": SYSTEM, "u": USER, "a": ASSISTANT}[text[-1]] == leave:
                yield text


@lru_cache(maxsize=100_000)
def best(codes: str, entry: int, leave: int) -> Best:
    """(cost, audit) of the cheapest way from one state to the other over the turns, least audit first."""
    free = sum(c != "d" for c in codes)
    base = DELETE * (len(codes) - free)
    incumbent: Best = None
    # deleting all turns and inserting two bounds every cost, and with it the lengths
    most = free + (DELETE * free + 2 * INSERT) // INSERT + 1
    for text in sorted(targets(entry, leave, most), key=lambda t: (_off(len(t) - free), t)):
        least = base + _off(len(text) - free)
        if incumbent and least > incumbent[0]:
            break
        found = align(codes, text, incumbent[0] if incumbent else DELETE * len(codes) + INSERT * len(text) + CUT)
        if found and (incumbent is None or found < incumbent):
            incumbent = found
    return incumbent


Part = dict[tuple[int, int], tuple[int, str]]


def part(codes: str, entries: tuple[int, ...] = (NOTHING, SYSTEM, USER, ASSISTANT)) -> Part:
    """The best ways over a chunk from each of the states to each."""
    return {(e, x): b for e in entries for x in range(4) if (b := best(codes, e, x))}


def joined(a: Part, b: Part) -> Part:
    """The best ways over two parts, one after the other."""
    out: Part = {}
    for (e, y), (cost, audit) in a.items():
        for x in range(4):
            if ahead := b.get((y, x)):
                way = cost + ahead[0], audit + ahead[1]
                if (e, x) not in out or way < out[e, x]:
                    out[e, x] = way
    return out


class Parts:
    """Joins parts pairwise, as binary counting does, so that each is copied a logarithm of times."""

    def __init__(self):
        self.held: list[tuple[int, Part]] = []

    def add(self, new: Part) -> None:
        level = 0
        while self.held and self.held[-1][0] == level:
            new, level = joined(self.held.pop()[1], new), level + 1
        self.held.append((level, new))

    def all(self) -> Part:
        out: Part = {(e, e): (0, "") for e in range(4)}
        for _, p in self.held:
            out = joined(out, p)
        return out


def finish(ways: Part) -> tuple[int, str]:
    """Cost and audit from the beginning to an end that the grammar allows."""
    return min(ways[NOTHING, x] for x in (NOTHING, ASSISTANT) if (NOTHING, x) in ways)


class Repair:
    """Digest of the repaired conversation, from its audit and then its turns in order."""

    def __init__(self, audit: str):
        self.audit, self.at, self.place, self.lines = audit, 0, 0, 0
        self.system = (len(audit) - audit.count("D")) % 2
        self.digest = hashlib.sha256()

    def _role(self) -> str:
        return "assistant" if (self.place - self.system) % 2 else "user"

    def _line(self, role: str, text: bytes) -> None:
        self.digest.update((b"\n" if self.lines else b"") + role.encode() + b":")
        self.digest.update(text)
        self.lines += 1
        self.place += 1

    def inserted(self) -> None:
        while self.audit[self.at:self.at + 1] == "I":
            self._line(self._role(), b"")
            self.at += 1

    def turn(self, role: str, text: bytes, n: int) -> None:
        for _ in range(n):
            self.inserted()
            edit = self.audit[self.at]
            self.at += 1
            if edit != "D":
                self._line(role if edit == "K" else self._role(), text)

    def hex(self) -> str:
        self.inserted()
        return self.digest.hexdigest()


class Turns:
    """What is known of a run of one conversation's rows."""

    def __init__(self, begins: bool):
        #: the first chunk of a conversation that begins here starts from nothing
        self.entries = (NOTHING,) if begins else (NOTHING, SYSTEM, USER, ASSISTANT)
        self.parts, self.codes = Parts(), ""
        self.blank = self.duplicate = self.truncated = self.illegal = self.distinct = 0
        self.first = self.last = self.first_turn = self.least = self.last_turn = None

    def add(self, turn: int | None, role: str, text: bytes, n: int, seen: bool) -> None:
        if not n:
            return
        initial, stripped = role[:1], text.rstrip(_SPACE)
        if not stripped:
            self.blank += n
            codes = "d" * n
        else:
            self.duplicate += n - (not seen)
            cut = not seen and stripped[-1] not in b".!?"
            self.truncated += cut
            code = initial if initial in ("s", "u", "a") else "x"
            codes = "d" * n if seen else (code.upper() if cut else code) + "d" * (n - 1)
        self.illegal += n - 1 + (self.last is not None and self.last + initial not in ("su", "ua", "au"))
        self.last = initial
        if self.first is None:
            self.first, self.first_turn = initial, turn
        if turn is not None and turn != self.last_turn:
            self.distinct += 1
            self.least = turn if self.least is None else self.least
        self.last_turn = turn
        self.codes += codes
        at = 0
        while len(self.codes) - at > CHUNK:
            self._chunk(self.codes[at:at + CHUNK])
            at += CHUNK
        self.codes = self.codes[at:]

    def _chunk(self, codes: str) -> None:
        self.parts.add(part(codes, self.entries))
        self.entries = (NOTHING, SYSTEM, USER, ASSISTANT)

    def ways(self) -> Part:
        if self.codes:
            self._chunk(self.codes)
            self.codes = ""
        return self.parts.all()

    def result(self, ways: Part) -> list:
        gaps = 0 if self.least is None else self.last_turn - self.least + 1 - self.distinct
        return [gaps, self.blank, self.duplicate, self.truncated, self.illegal, *finish(ways)]

    def state(self) -> str:
        """What the rows before and after need to know of these."""
        names = ("blank", "duplicate", "truncated", "illegal", "distinct", "first", "last", "first_turn", "least", "last_turn")
        return json.dumps({"ways": [[*k, *v] for k, v in self.ways().items()]} | {k: getattr(self, k) for k in names})

    def follow(self, state: str) -> None:
        """Goes on with the rows of another task."""
        new = json.loads(state)
        self.parts.add({(e, x): (cost, audit) for e, x, cost, audit in new["ways"]})
        if new["first"] is None:
            return
        for k in ("blank", "duplicate", "truncated", "illegal", "distinct"):
            setattr(self, k, getattr(self, k) + new[k])
        if self.first is None:
            self.first, self.first_turn = new["first"], new["first_turn"]
        else:
            self.illegal += self.last + new["first"] not in ("su", "ua", "au")
            self.distinct -= new["first_turn"] is not None and new["first_turn"] == self.last_turn
        self.least = new["least"] if self.least is None else self.least
        self.last, self.last_turn = new["last"], new["last_turn"]


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, n): n equal rows after damage; 0 where a row was dropped."""
    def text_of(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))
    src = only(conversations, "conv_id", "turn", "role", "text").withColumn("turn", F.col("turn").cast("long"))
    kind = F.crc32(F.concat(text_of("conv_id"), F.lit(":"), text_of("turn")).cast("binary")) % 20
    rows = src.select("conv_id", "turn", text_of("role").alias("role"), text_of("text").alias("text"), kind.alias("kind"))
    gone = F.col("kind") == 0
    text = F.when(F.col("kind") <= 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(gone, "").when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    rows = rows.select("conv_id", F.when(~gone, F.col("turn")).alias("turn"), role.alias("role"), text.alias("text"),
                       F.when(gone, 0).when(F.col("kind") == 3, 2).otherwise(1).cast("long").alias("n"))
    return rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("n").alias("n"))


def in_order(rows: DataFrame) -> DataFrame:
    """The rows with ``seen`` (role and text came in an earlier turn), each conversation's in order,
    conversation after conversation over the partitions."""
    rows = rows.withColumn("digest", F.sha2("text", 256))
    first = rows.filter("n > 0").groupBy(F.col("conv_id").alias("conv"), F.col("role").alias("as_role"), F.col("digest").alias("as_digest")).agg(
        F.min("turn").alias("from"), F.max(F.col("turn").isNull()).alias("nameless"), F.count(F.lit(1)).alias("turns")).filter("turns > 1").drop("turns")
    same = F.col("conv_id").eqNullSafe(F.col("conv")) & (F.col("role") == F.col("as_role")) & (F.col("digest") == F.col("as_digest"))
    later = F.col("turn").isNotNull() & (F.col("nameless") | (F.col("turn") > F.col("from")))
    rows = rows.join(first, same, "left").withColumn("seen", F.coalesce(later, F.lit(False)))
    order = ["conv_id", "turn", "role", "digest"]
    dealt = rows.select(*order, "text", "n", "seen").repartitionByRange(partitions(rows.sparkSession), *order)
    return dealt.sortWithinPartitions(*order).select("conv_id", "turn", "role", "text", "n", "seen")


def repaired(rows: DataFrame) -> DataFrame:
    """(conv_id, *RESULT) of rows in order."""
    kind_of_id = rows.schema["conv_id"].dataType.simpleString()
    arrow = [("gaps", pa.int64()), ("blank", pa.int64()), ("duplicate", pa.int64()), ("truncated", pa.int64()), ("illegal", pa.int64()),
             ("cost", pa.int64()), ("audit", pa.string()), ("repaired_sha256", pa.string())]
    schema = f"conv_id {kind_of_id}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"

    def fields(b: pa.RecordBatch) -> Iterator[tuple]:
        """conv_id, turn, role, text (bytes), n, seen; one text at a time."""
        ids, turns, roles, ns, seen = (b.column(i).to_pylist() for i in (0, 1, 2, 4, 5))
        for k, text in enumerate(b.column(3).cast(pa.large_binary())):
            yield ids[k], turns[k], roles[k], text.as_py(), ns[k], seen[k]

    def by_task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pid, id_type, out = TaskContext.get().partitionId(), None, []
        now, known, held, size, spilled, at, first = None, None, [], 0, False, 0, True

        def batch() -> pa.RecordBatch:
            # kind: 0 what one task knows, 1 a turn that goes on, 2 a result
            names = [("conv_id", id_type), ("kind", pa.int32()), ("pid", pa.int32()), ("seq", pa.int64()), ("state", pa.string()),
                     ("role", pa.string()), ("text", pa.binary()), ("n", pa.int64()), *arrow]
            made = pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, (_, t) in enumerate(names)], [n for n, _ in names])
            out.clear()
            return made

        def close(last: bool) -> None:
            nonlocal at
            if first or last or spilled:  # another task may have more of it
                out.append((now, 0, pid, 0, known.state(), None, None, None, *[None] * 8))
                for role, text, n in held:
                    at += 1
                    out.append((now, 1, pid, at, None, role, text, n, *[None] * 8))
            else:
                found = known.result(known.ways())
                repair = Repair(found[-1])
                for role, text, n in held:
                    repair.turn(role, text, n)
                out.append((now, 2, pid, 0, None, None, None, None, *found, repair.hex()))

        for b in batches:
            id_type = b.schema.field(0).type
            for conv, turn, role, text, n, seen in fields(b):
                if known is None or conv != now:
                    if known is not None:
                        close(False)
                        first = False
                    now, known, held, size, spilled = conv, Turns(begins=not first), [], 0, False
                known.add(turn, role, text, n, seen)
                if n:
                    held.append((role, text, n))
                    size += len(text) + 64
                if size > HELD:
                    spilled = True
                    for r, t, c in held:
                        at += 1
                        out.append((now, 1, pid, at, None, r, t, c, *[None] * 8))
                    held, size = [], 0
                    yield batch()
                if len(out) >= 1000:
                    yield batch()
        if known is not None:
            close(True)
        if out:
            yield batch()
        release_memory()

    def across(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        id_type, out, now, known, found, repair = None, [], None, None, None, None

        def batch() -> pa.RecordBatch:
            names = [("conv_id", id_type), *arrow]
            made = pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, (_, t) in enumerate(names)], [n for n, _ in names])
            out.clear()
            return made

        def close() -> None:
            ready = repair or Repair(known.result(known.parts.all())[-1])
            out.append((now, *(found or known.result(known.parts.all())), ready.hex()))
        for b in batches:
            id_type = b.schema.field(0).type
            cols = {n: b.column(n).to_pylist() for n in ("conv_id", "kind", "state", "role", "n")}
            for k, text in enumerate(b.column("text")):
                conv = cols["conv_id"][k]
                if known is None or conv != now:
                    if known is not None:
                        close()
                    now, known, found, repair = conv, Turns(True), None, None
                if cols["kind"][k] == 0:
                    known.follow(cols["state"][k])
                else:
                    if repair is None:
                        found = known.result(known.parts.all())
                        repair = Repair(found[-1])
                    repair.turn(cols["role"][k], text.as_py(), cols["n"][k])
            if len(out) >= 1000:
                yield batch()
        if known is not None:
            close()
        if out:
            yield batch()
        release_memory()

    parts_of = f"conv_id {kind_of_id}, kind int, pid int, seq long, state string, role string, text binary, n long, " + schema.split(", ", 1)[1]
    made = materialize(rows.mapInArrow(by_task, parts_of), "turns-parts")
    whole = made.filter("kind = 2").select("conv_id", *RESULT)
    rest = made.filter("kind < 2").select("conv_id", "kind", "pid", "seq", "state", "role", "text", "n")
    rest = rest.repartition(partitions(rows.sparkSession), "conv_id").sortWithinPartitions("conv_id", "kind", "pid", "seq")
    return whole.unionAll(rest.mapInArrow(across, schema))


def repair_conversations(conversations: DataFrame) -> DataFrame:
    """Damage by rule, then repair: (conv_id, *RESULT) of every conv_id."""
    return repaired(in_order(damaged(conversations)))
