"""Conversation structure repair by one integer minimum.

A repair walks over the rows of a conversation and edits them so that the role initials
read ``(s?(ua)+)?``. Its weight is one integer: the high digits are the cost, and below
them every letter of the audit has a digit of fixed width, the first letter the highest;
places without a letter are zero. So the least integer is the cheapest repair, and
among equal costs the one whose audit comes first in ASCII order, a prefix before what
it begins. The graph has four nodes after each row (what the roles read so far); two
paths to a node consumed the same rows, so their audits differ within both lengths
unless one has more insertions and costs more, and the lesser weight stays less whatever
follows. The minimum over integers is all that decides.

The paths to the four nodes soon share their beginning. What they share is cut off
every ``WINDOW`` rows, which leaves the order of the weights as it is, so integers stay
short however long a conversation is.

Rows are shuffled twice, by conversation: once without texts for the repair, and once
with them for the digest of the repaired text. Both are read as a stream: a task holds
a few bytes for each row of a conversation, and never its texts."""

import hashlib

import pyarrow as pa
from pyspark.sql import functions as F

SPACES = " \t\n\x0b\x0c\r"
ENDS = ".!?"
#: Digits of the letters, in ASCII order; zero pads.
DIGITS = {"D": 1, "I": 2, "K": 3, "R": 4}
LETTERS = {v: k for k, v in DIGITS.items()}
KEEP, REROLE, DELETE, INSERT, OPEN_END = 0, 2, 3, 2, 1
WINDOW = 512
#: What the roles read so far: nothing, the system's, a user's last, an assistant's last.
NONE, SYSTEM, USER, ASSISTANT = range(4)
#: Where a role leads.
STEPS = {(NONE, "s"): SYSTEM, (NONE, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
ROLES = {USER: "user", ASSISTANT: "assistant"}
_TURNS = {state: "a" if state == USER else "u" for state in range(4)}
COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def damaged(rows):
    """The rows after damage, as conv_id, turn, role, text and gone (dropped rows stay,
    marked, so that no conversation is lost). A null role or text is one space, and so
    is a null conv_id or turn in the checksum."""
    one = F.lit(" ")
    key = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), one), F.coalesce(F.col("turn").cast("string"), one))
    kind, body = F.crc32(key.cast("binary")) % 20, F.coalesce("text", one)
    return rows.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.when(kind == 4, F.lit("user")).otherwise(F.coalesce("role", one)).alias("role"),
        F.when(kind == 1, F.lit("")).when(kind == 2, F.translate(body, ENDS, "")).otherwise(body).alias("text"),
        (kind == 0).alias("gone"),
        F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("again"),
    ).drop("again")


class Repair:
    """The cheapest repair of one conversation, fed row by row."""

    def __init__(self, window=WINDOW):
        self.window, self.since, self.audit = window, 0, []
        self.width = 0
        self._open({NONE: (0, 0)})

    def _open(self, best):
        """Makes room for the letters of the next rows."""
        longest = max(p for _, p in best.values())
        width = longest + 3 * self.window + 3
        wider, narrower = 3 * max(0, width - self.width), 3 * max(0, self.width - width)
        self.best = {s: (w << wider >> narrower, p) for s, (w, p) in best.items()}
        self.width, self.since = width, 0

    def _offer(self, into, state, weight, at, letter, cost):
        weight += (cost << 3 * self.width) + (DIGITS[letter] << 3 * (self.width - 1 - at))
        if state not in into or weight < into[state][0]:
            into[state] = (weight, at + 1)

    def _inserted(self, best):
        """Each node's least weight with insertions: at most two in a row are of use."""
        for _ in range(2):
            for state, (weight, at) in list(best.items()):
                turn = _TURNS[state]
                self._offer(best, STEPS[state, turn], weight, at, "I", INSERT)
        return best

    def add(self, initial, must_go, truncated):
        """The next row: its role's initial, and whether it is blank or a duplicate."""
        after, more = {}, OPEN_END if truncated else 0
        for state, (weight, at) in self._inserted(self.best).items():
            self._offer(after, state, weight, at, "D", DELETE)
            if not must_go:
                if (state, initial) in STEPS:
                    self._offer(after, STEPS[state, initial], weight, at, "K", KEEP + more)
                self._offer(after, STEPS[state, _TURNS[state]], weight, at, "R", REROLE + more)
        self.best = after
        self.since += 1
        if self.since == self.window:
            self._cut()

    def _letters(self, weight, at):
        codes = weight & ((1 << 3 * self.width) - 1)
        return [codes >> 3 * (self.width - 1 - k) & 7 for k in range(at)]

    def _cut(self):
        """Takes the letters that all paths share out of the integers."""
        paths = {s: self._letters(*x) for s, x in self.best.items()}
        shared = 0
        for column in zip(*paths.values()):
            if len(set(column)) > 1:
                break
            shared += 1
        self.audit += next(iter(paths.values()))[:shared]
        low, fresh = (1 << 3 * self.width) - 1, {}
        for s, (w, p) in self.best.items():
            code = (w & low) << 3 * shared & low
            fresh[s] = ((w >> 3 * self.width << 3 * self.width) + code, p - shared)
        self._open(fresh)

    def result(self):
        """(cost, audit)."""
        best = self._inserted(dict(self.best))
        weight, at = min(best[s] for s in (NONE, ASSISTANT) if s in best)
        return weight >> 3 * self.width, "".join(LETTERS[d] for d in self.audit + self._letters(weight, at))


def replay(audit):
    """For every letter of an audit, the state it leads from; a generator that is sent the
    initial of a kept row and yields (letter, role or None): what ends up in the text."""
    state, initial = NONE, None
    for letter in audit:
        if letter == "D":
            initial = yield letter, None
            continue
        if letter == "K":
            initial = yield letter, None
            state = STEPS[state, initial]
            continue
        state = STEPS[state, _TURNS[state]]
        initial = yield letter, ROLES[state]


class _Faults:
    """Counts of one conversation and its repair."""

    def __init__(self, conv):
        self.conv, self.repair, self.seen = conv, Repair(), set()
        self.low = self.high = self.last = self.before = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0

    def add(self, turn, initial, digest, blank, open_end):
        if turn is not None:
            self.low = turn if self.low is None else self.low
            self.high = turn
            self.turns += turn != self.last
            self.last = turn
        again = digest in self.seen
        self.seen.add(digest)
        truncated = not blank and not again and open_end
        self.blank += blank
        self.duplicate += again and not blank
        self.truncated += truncated
        if self.before is not None:
            self.illegal += self.before + initial not in ("su", "ua", "au")
        self.before = initial
        self.repair.add(initial, blank or again, truncated)

    def row(self):
        cost, audit = self.repair.result()
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return (self.conv, gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, audit)


def _repaired(schema):
    def run(batches):
        own, out = None, []
        for batch in batches:
            for conv, turn, initial, digest, blank, open_end, gone in zip(*(c.to_pylist() for c in batch.columns)):
                if own is None or own.conv != conv:
                    if own is not None:
                        out.append(own.row())
                    own = _Faults(conv)
                if not gone:
                    own.add(turn, initial, digest, blank, open_end)
            if out:
                yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in out], schema)
                out = []
        if own is not None:
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, own.row()))], schema)

    return run


class _Text:
    """The digest of a conversation's repaired text, row by row."""

    def __init__(self, result):
        self.result, self.steps = result, replay(result["audit"])
        self.hash, self.started = hashlib.sha256(), False
        self.step = next(self.steps, None)

    def _put(self, role, body):
        if self.started:
            self.hash.update(b"\n")
        self.started = True
        self.hash.update(f"{role}:{body}".encode())

    def _next(self, initial=None):
        try:
            self.step = self.steps.send(initial)
        except StopIteration:
            self.step = None

    def _insert(self):
        while self.step is not None and self.step[0] == "I":
            self._put(self.step[1], "")
            self._next()

    def add(self, role, body):
        self._insert()
        letter, fresh = self.step
        if letter != "D":
            self._put(fresh or role, body)
        self._next(role[:1])

    def row(self):
        self._insert()
        return self.result | {"repaired_sha256": self.hash.hexdigest()}


def _digests(schema):
    def run(batches):
        own, out = None, []
        for batch in batches:
            columns = {n: c.to_pylist() for n, c in zip(batch.schema.names, batch.columns)}
            for i, text in enumerate(columns["text"]):
                if columns["part"][i] == 0:
                    if own is not None:
                        out.append(own.row())
                    own = _Text({n: columns[n][i] for n in ("conv_id", *COUNTS, "audit")})
                else:
                    own.add(columns["role"][i], text)
            if out:
                yield pa.RecordBatch.from_pylist(out, schema)
                out = []
        if own is not None:
            yield pa.RecordBatch.from_pylist([own.row()], schema)

    return run


_KINDS = {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32()}


def repaired(rows):
    """conv_id, the counts gaps, blank, duplicate, truncated, illegal and cost, the audit and
    repaired_sha256 for every conv_id of ``rows`` (conv_id, turn, role, text; other columns
    are ignored), as damaged by ``damaged`` before.

    Rows with a null conv_id are one conversation. Rows are taken by turn, nulls first; rows
    of the same turn by a digest of role and text, so equal rows are neighbours. A
    conversation without a row left has zeros, no audit and the digest of nothing."""
    kind = dict(rows.dtypes)["conv_id"]
    own = damaged(rows.select("conv_id", "turn", "role", "text"))
    body = F.rtrim(F.col("text"), F.lit(SPACES))
    digest = F.md5(F.concat_ws(":", F.length("role").cast("string"), "role", "text").cast("binary"))
    own = own.withColumn("digest", digest)
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("digest")]
    slim = own.select(
        "conv_id",
        "turn",
        F.substring("role", 1, 1).alias("initial"),
        "digest",
        (body == "").alias("blank"),
        (~F.right(body, F.lit(1)).isin(*ENDS)).alias("open_end"),
        "gone",
    )
    names = ["conv_id", *COUNTS, "audit"]
    schema = pa.schema([("conv_id", _KINDS.get(kind, pa.int64())), *((n, pa.int64()) for n in COUNTS), ("audit", pa.string())])
    layout = f"conv_id {kind}, {', '.join(f'{n} long' for n in COUNTS)}, audit string"
    found = slim.repartition("conv_id").sortWithinPartitions(*order).mapInArrow(_repaired(schema), layout)
    texts = own.where("not gone").select("conv_id", "turn", "digest", "role", "text", F.lit(1).alias("part"))
    both = found.withColumn("part", F.lit(0)).unionByName(texts, allowMissingColumns=True)
    both = both.repartition("conv_id").sortWithinPartitions(F.col("conv_id"), F.col("part"), *order[1:])
    both = both.select(*names, "part", "role", "text")
    return both.mapInArrow(_digests(schema.append(pa.field("repaired_sha256", pa.string()))), f"{layout}, repaired_sha256 string")
