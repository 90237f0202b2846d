"""Structure of conversations: faults of their turns, and the cheapest edits that make them alternate.

A repaired conversation is empty, or an optional system turn and then user and assistant in turn, the
assistant last.  Edits of a turn: Keep (0), Rerole to user or assistant (1), Delete (2; blank and repeated
turns must go); Insert adds an empty user or assistant turn anywhere (5).  A cut-off turn that stays costs 5.
Of the cheapest edits, those whose initials in order are the least in ASCII are taken.

Conversations are dealt to tasks by id and sorted by turn (Spark sorts, and spills).  Each comes twice: its
turns without texts, last turn first, and its turns with texts, first turn first.  On the first pass the
task carries, across Arrow batches, the least cost from each of four states to the end, and notes for every
turn one byte: the best edit in each state, two bits each.  The least initial among the cheapest edits is
the right one, as what follows depends on the state alone.  On the second pass the bytes, read backwards,
tell the edits while the texts stream by, so no conversation is held: of a giant one the bytes beyond
``SPILL`` go to files in the shared folder (deleted when read; files of a lost task are never read).

Repeated turns (same role and text as an earlier one) are found beforehand by a window over the hash of
role and text.

Defined results: turns come in order of the turn number (null first), then role and hash of the text; a
null role or text counts as one space, so a null text is blank; a null conversation id is a conversation of
its own; repeated rows are turns of their own; extra columns have no influence; an empty table gives an
empty table.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import pyarrow.fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakelet.session import new_run_dir

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: states: nothing yet, after system, after user, after assistant; ASCII order of the edits
START, SYSTEM, USER, ASSISTANT = range(4)
EDITS = "DIKR"
#: the state after the one turn that may be inserted or a turn given another role, and that turn's role
NEXT = (USER, USER, ASSISTANT, USER)
NEXT_ROLE = ("user", "user", "assistant", "user")
#: where a kept turn leads, by its initial
KEPT = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
#: what becomes of a turn: it may stay, it costs more if it stays, it must go
FINE, CUT_OFF, MUST_GO = range(3)
BLANKS = " \t\n\x0b\x0c\r"
#: edit bytes held in memory
SPILL = 4_000_000

DIGEST_SCHEMA = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string")
TURN_SCHEMA = "conv_id long, place long, edit string, role string, text string"


# -- edits -----------------------------------------------------------------------------------------
def settled(costs: list[int], edits: list[int]) -> tuple[tuple[int, ...], int, int]:
    """Let turns be inserted first; costs less their minimum, the minimum, the byte of the edits."""
    for s in (USER, ASSISTANT):  # one insertion leads to the other state; two lead back at a cost
        if INSERT + costs[NEXT[s]] < costs[s] or INSERT + costs[NEXT[s]] == costs[s] and EDITS[edits[s]] > "I":
            costs[s], edits[s] = INSERT + costs[NEXT[s]], EDITS.index("I")
    for s in (START, SYSTEM):
        if INSERT + costs[USER] < costs[s] or INSERT + costs[USER] == costs[s] and EDITS[edits[s]] > "I":
            costs[s], edits[s] = INSERT + costs[USER], EDITS.index("I")
    least = min(costs)
    return tuple(c - least for c in costs), least, sum(e << 2 * s for s, e in enumerate(edits))


@lru_cache(maxsize=None)  # the differences of costs are bounded, so there are few
def step(costs: tuple[int, ...], initial: str, fate: int) -> tuple[tuple[int, ...], int, int]:
    """One turn further to the front: costs before it, what all of them have in common, the byte of the edits."""
    stay = TRUNCATED if fate == CUT_OFF else 0
    new, edits = [], []
    for s in range(4):
        options = [(DELETE + costs[s], EDITS.index("D"))]
        if fate != MUST_GO:
            if s in KEPT.get(initial, {}):
                options.append((KEEP + stay + costs[KEPT[initial][s]], EDITS.index("K")))
            options.append((REROLE + stay + costs[NEXT[s]], EDITS.index("R")))
        cost, edit = min(options)
        new.append(cost)
        edits.append(edit)
    return settled(new, edits)


#: behind the last turn: only nothing and an assistant's turn end a conversation
END = (0, 2 * INSERT, INSERT, 0)


class Edits:
    """The bytes of one conversation, appended from its last turn on and read from the first."""

    def __init__(self, folder: str, limit: int):
        self.folder, self.limit, self.held, self.files = folder, limit, bytearray(), []

    def append(self, edits: int) -> None:
        self.held.append(edits)
        if len(self.held) >= self.limit:
            path = f"{self.folder}/edits-{uuid.uuid4().hex}"
            system, at = pa_path(path)
            system.create_dir(at.rsplit("/", 1)[0], recursive=True)
            with system.open_output_stream(at) as out:
                out.write(bytes(self.held))
            self.files.append(path)
            self.held = bytearray()

    def __iter__(self) -> Iterator[int]:
        yield from reversed(self.held)
        for path in reversed(self.files):
            system, at = pa_path(path)
            with system.open_input_stream(at) as source:
                held = source.read()
            system.delete_file(at)
            yield from reversed(held)


def pa_path(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(path)


class Conversation:
    """What the task carries for the conversation that streams by."""

    def __init__(self, conv_id: int | None, edits: Edits):
        self.conv_id, self.edits, self.costs, self.cost = conv_id, edits, END, 0
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.after = self.first = self.last = None  # initial and turn of the turn before in the stream; highest turn
        self.turns = 0
        self.state, self.bytes, self.audit, self.repaired, self.place = START, None, [], hashlib.sha256(), 0

    def look(self, turn: int, has_turn: bool, initial: str, fault: str) -> None:
        """First pass: one turn further to the front."""
        if has_turn and turn != self.first:
            self.turns += 1
            self.first = turn
            self.last = turn if self.last is None else self.last
        if self.after is not None and initial + self.after not in ("su", "ua", "au"):
            self.illegal += 1
        self.after = initial
        self.blank += fault == "b"
        self.duplicate += fault == "d"
        self.truncated += fault == "t"
        self.costs, more, edits = step(self.costs, initial if initial in KEPT else "", {"": FINE, "t": CUT_OFF}.get(fault, MUST_GO))
        self.cost += more
        self.edits.append(edits)

    def _put(self, edit: str, role: str, text: str) -> tuple[str, str | None, str | None]:
        self.audit.append(edit)
        if edit == "D":
            return edit, None, None
        self.repaired.update((("\n" if self.place else "") + role + ":" + text).encode("utf-8", "surrogatepass"))
        self.place += 1
        return edit, role, text

    def mend(self, role: str, text: str) -> Iterator[tuple[str, str | None, str | None]]:
        """Second pass: the edits up to and with the next turn."""
        if self.bytes is None:
            self.bytes, self.cost = iter(self.edits), self.cost + self.costs[START]
        edits = next(self.bytes)
        while (edit := EDITS[edits >> 2 * self.state & 3]) == "I":
            yield self._put("I", NEXT_ROLE[self.state], "")
            self.state = NEXT[self.state]
        if edit == "R":
            role = NEXT_ROLE[self.state]
        yield self._put(edit, role, text)
        if edit != "D":
            self.state = NEXT[self.state] if edit == "R" else KEPT[role[:1]][self.state]

    def finish(self) -> Iterator[tuple[str, str | None, str | None]]:
        while self.state in (SYSTEM, USER):
            yield self._put("I", NEXT_ROLE[self.state], "")
            self.state = NEXT[self.state]
        if self.bytes is not None:
            assert next(self.bytes, None) is None

    def digest(self) -> tuple:
        gaps = 0 if self.last is None else self.last - self.first + 1 - self.turns
        return (self.conv_id, gaps, self.blank, self.duplicate, self.truncated, self.illegal, self.cost, "".join(self.audit), self.repaired.hexdigest())


# -- jobs ------------------------------------------------------------------------------------------
def damage(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, turn, role, text) with one row in four damaged, by the crc32 of ``conv_id:turn`` modulo 20:
    0 lost, 1 emptied, 2 without its ends of sentences, 3 twice, 4 with role user.  Nulls count as one space."""
    space = F.lit(" ")
    conv, turn = rows[conv_col].cast("long"), rows[turn_col].cast("long")
    role, text = (F.coalesce(rows[c].cast("string"), space) for c in (role_col, text_col))
    kind = F.crc32(F.concat(F.coalesce(conv.cast("string"), space), F.lit(":"), F.coalesce(turn.cast("string"), space))) % 20
    own = rows.select(conv.alias("conv_id"), turn.alias("turn"), kind.alias("kind"), role.alias("role"), text.alias("text")).where("kind <> 0")
    times = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return own.select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
                      F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
                      F.explode(times).alias("copy")).drop("copy")


def stream(rows: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """The turns of ``rows`` (conv_id, turn, role, text) as the tasks read them: dealt by conversation,
    sorted by conversation, pass and turn.  ``ids``: conversations (conv_id) that may have no row."""
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    own = rows.select(F.col("conv_id").isNotNull().alias("has_conv"), F.coalesce("conv_id", F.lit(0)).alias("conv"), "turn", role.alias("role"), text.alias("text"))
    own = own.withColumn("h", F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")))
    inside = F.rtrim("text", F.lit(BLANKS))
    nth = F.row_number().over(Window.partitionBy("has_conv", "conv", "h").orderBy(F.col("turn").asc_nulls_first()))
    ends = ~F.substring(inside, -1, 1).isin(".", "!", "?")
    short = own.select("has_conv", "conv", "turn", "role", "h", F.when(inside == "", "b").when(ends, "t").otherwise("").alias("fault"))
    short = short.withColumn("again", nth > 1).withColumn("fault", F.when((F.col("fault") != "b") & F.col("again"), "d").otherwise(F.col("fault")))

    def part(df: DataFrame, number: int, given: dict) -> DataFrame:
        kinds = {"turn0": "long", "role0": "string", "h0": "string", "again0": "boolean", "turn1": "long", "role1": "string", "h1": "string",
                 "turn": "long", "has_turn": "boolean", "initial": "string", "fault": "string", "text": "string"}
        cols = [(given[c] if c in given else F.lit(None).cast(t)).alias(c) for c, t in kinds.items()]
        return df.select("has_conv", "conv", F.lit(number).alias("pass"), *cols)

    plain = {"turn": F.coalesce("turn", F.lit(0)), "has_turn": F.col("turn").isNotNull()}
    blank = {"turn": F.lit(0).cast("long"), "has_turn": F.lit(False)}
    first = part(short, 0, plain | {"turn0": F.col("turn"), "role0": F.col("role"), "h0": F.col("h"), "again0": F.col("again"),
                                    "initial": F.substring("role", 1, 1), "fault": F.col("fault")})
    second = part(own, 1, blank | {"turn1": F.col("turn"), "role1": F.col("role"), "h1": F.col("h"), "text": F.col("text")})
    both = first.unionByName(second)
    if ids is not None:
        every = ids.select(F.col("conv_id").isNotNull().alias("has_conv"), F.coalesce("conv_id", F.lit(0)).alias("conv")).distinct()
        both = both.unionByName(part(every, -1, blank))
    # the first pass takes the exact reverse of the second one's order
    order = [F.col("has_conv"), F.col("conv"), F.col("pass"), F.col("turn0").desc_nulls_last(), F.col("role0").desc(), F.col("h0").desc(), F.col("again0").desc(),
             F.col("turn1").asc_nulls_first(), F.col("role1"), F.col("h1")]
    return (both.repartition("has_conv", "conv").sortWithinPartitions(*order)
            .select("has_conv", "conv", "pass", "turn", "has_turn", "initial", "fault", F.col("role1").alias("role"), "text"))


def _walk(frames: Iterator[pd.DataFrame], folder: str, spill: int) -> Iterator[list[tuple[Conversation, tuple | None]]]:
    """For each batch: (conversation, edit) for every edit made, (conversation, None) for every one that ended."""
    conv = None
    for frame in frames:
        out: list[tuple[Conversation, tuple | None]] = []
        for has, own, number, turn, has_turn, initial, fault, role, text in zip(*(frame[c].tolist() for c in frame.columns)):
            own = own if has else None
            if conv is None or conv.conv_id != own:
                if conv is not None:
                    out += [(conv, e) for e in conv.finish()] + [(conv, None)]
                conv = Conversation(own, Edits(folder, spill))
            if number == 0:
                conv.look(turn, has_turn, initial, fault)
            elif number == 1:
                out += [(conv, e) for e in conv.mend(role, text)]
        yield out
    if conv is not None:
        yield [(conv, e) for e in conv.finish()] + [(conv, None)]


def digests(rows: DataFrame, ids: DataFrame | None = None, spill: int = SPILL) -> DataFrame:
    """One row a conversation: faults, cost, the initials of the edits, and the hash of what ``repaired`` gives."""
    folder = new_run_dir(rows.sparkSession, "repair-edits")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for out in _walk(frames, folder, spill):
            done = pd.DataFrame([c.digest() for c, e in out if e is None], columns=[f.split()[0] for f in DIGEST_SCHEMA.split(", ")], dtype=object)
            yield done.astype({"conv_id": "Int64"})

    return stream(rows, ids).mapInPandas(run, DIGEST_SCHEMA)


def repaired(rows: DataFrame, spill: int = SPILL) -> DataFrame:
    """The repaired turns, as (conv_id, place from 0, edit, role, text)."""
    folder = new_run_dir(rows.sparkSession, "repair-edits")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        place, own = 0, None
        for out in _walk(frames, folder, spill):
            got = []
            for c, e in out:
                if c is not own:
                    place, own = 0, c
                if e is not None and e[0] != "D":
                    got.append((c.conv_id, place, *e))
                    place += 1
            yield pd.DataFrame(got, columns=["conv_id", "place", "edit", "role", "text"], dtype=object).astype({"conv_id": "Int64"})

    return stream(rows).mapInPandas(run, TURN_SCHEMA)
