"""Chat formatting by token-level assembly.

Each turn is a segment of its own: its text, with control strings escaped, is
encoded by itself, and reserved ids above the vocabulary are spliced in for
the conversation's begin, the roles and the ends of turns. Content can hence
never produce a control id. The loss mask follows from the segments' lengths:
prefix sums give each segment's place, and a place is under the loss exactly
if it lies in the content of an assistant segment.

Rendered as text the reserved ids are the control strings below; escaping puts
a backslash before each backslash and each control string of the content, and
unescaping removes one again, so the text form reads back as well.

Segments are escaped and encoded row by row before any shuffle; turns then
meet by conversation, sorted, and are assembled one turn at a time.

Defined results: null text and null role are empty strings; a conversation
whose id is null is one conversation. Turns are ordered by turn (null first),
then role, then text; repeated rows are turns of their own. An empty table
gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qtrlens.llm.bpe import load_bpe
from qtrlens.llm.common import small_batches

# ---- fixed values: the template's control strings
BEGIN, END = "<conversation>\n", "</turn>\n"
ROLES = {"system": "### System: ", "user": "### User: ", "assistant": "### Assistant: "}
OTHER_ROLE = "### Role: "          # followed by the escaped role name and a line end
LOSS_ROLE = "assistant"
CONTROL = ["<conversation>", "</turn>", "### System:", "### User:", "### Assistant:", "### Role:"]
_ESCAPE = re.compile("|".join([r"\\", *map(re.escape, CONTROL)]))
_UNESCAPE = re.compile(r"\\(.)", re.DOTALL)


def escape(text: str) -> str:
    return _ESCAPE.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1", text)


class Template:
    """Reserved ids above a vocabulary and the strings they stand for."""

    def __init__(self, path: str):
        self.bpe = load_bpe(path)
        first = len(self.bpe.labels)
        self.begin, self.end, self.other = first, first + 1, first + 2
        self.role_id = {r: first + 3 + i for i, r in enumerate(ROLES)}
        self.role_of = {i: r for r, i in self.role_id.items()}
        self.first = first
        self.text = {self.begin: BEGIN, self.end: END, self.other: OTHER_ROLE,
                     **{i: ROLES[r] for r, i in self.role_id.items()}}

    def segment(self, role: str, text: str) -> tuple[list[int], int, int]:
        """Ids of a turn, and where its content starts and ends in them."""
        head = [self.role_id[role]] if role in self.role_id else \
            [self.other, *self.bpe.encode(escape(role).replace("\n", "\\\n") + "\n", special=False)]
        body = self.bpe.encode(escape(text), special=False)
        return [*head, *body, self.end], len(head), len(head) + len(body)

    def render(self, ids) -> str:
        """The ids as text, reserved ones as their control strings."""
        out, run = [], []
        for i in ids:
            if i < self.first:
                run.append(i)
                continue
            if run:
                out.append(self.bpe.decode(run))
                run = []
            out.append(self.text[i])
        if run:
            out.append(self.bpe.decode(run))
        return "".join(out)

    def read_back(self, ids) -> list[tuple[str, str]]:
        """(role, text) of every turn in a formatted sequence."""
        turns, at = [], 1
        ids = list(ids)
        while at < len(ids):
            stop = ids.index(self.end, at)
            body = ids[at + 1:stop]
            if ids[at] == self.other:
                name, _, text = self.bpe.decode(body).partition("\n")
                while (len(name) - len(name.rstrip("\\"))) % 2:    # that line end belongs to the name
                    more, _, text = text.partition("\n")
                    name += "\n" + more
                turns.append((unescape(name), unescape(text)))
            else:
                turns.append((self.role_of[ids[at]], unescape(self.bpe.decode(body))))
            at = stop + 1
        return turns


_TEMPLATES: dict[str, Template] = {}


def template(path: str) -> Template:
    if path not in _TEMPLATES:
        _TEMPLATES[path] = Template(path)
    return _TEMPLATES[path]


def _segments(path):
    def run(batches):
        t = template(path)
        for batch in batches:
            for lo in range(0, len(batch), 512):
                part = batch.slice(lo, 512)
                role = [r or "" for r in part.column(2).to_pylist()]
                text = [x or "" for x in part.column(3).to_pylist()]
                seg = [t.segment(r, x) for r, x in zip(role, text)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(role), pa.array(text),
                     pa.array([np.asarray(s[0], dtype=np.uint32).tobytes() for s in seg], pa.binary()),
                     pa.array([s[1] for s in seg], pa.int32()), pa.array([s[2] for s in seg], pa.int32())],
                    names=["conv_id", "turn", "role", "text", "ids", "body_from", "body_to"])
    return run


class _Conversation:
    """One conversation being assembled, turn by turn."""

    def __init__(self, conv_id, t: Template):
        self.conv_id, self.parts = conv_id, [np.array([t.begin], dtype=np.uint32)]
        self.sizes, self.body, self.loss = [1], [(0, 0)], [False]

    def add(self, role, ids, lo, hi):
        self.parts.append(np.frombuffer(ids, dtype=np.uint32))
        self.sizes.append(len(self.parts[-1]))
        self.body.append((lo, hi))
        self.loss.append(role == LOSS_ROLE)

    def done(self):
        """(ids, mask): segment starts are prefix sums of segment lengths; +1
        where content under the loss begins, -1 where it ends, summed up."""
        ids = np.concatenate(self.parts)
        start = np.cumsum([0, *self.sizes[:-1]])
        edge = np.zeros(len(ids) + 1, dtype=np.int32)
        for s, (lo, hi), on in zip(start, self.body, self.loss):
            if on:
                edge[s + lo] += 1
                edge[s + hi] -= 1
        return ids, np.cumsum(edge)[:-1].astype(bool)


def _assemble(path, finish, names, types):
    """Stream sorted segments into conversations; ``finish(conv_id, n, ids,
    mask, template)`` makes an output row."""
    def run(batches):
        t = template(path)
        current, rows = None, []

        def flush():
            out = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), types)], names=names)
            rows.clear()
            return out

        for batch in batches:
            cols = [batch.column(i).to_pylist() for i in range(batch.num_columns)]
            for conv_id, role, ids, lo, hi in zip(*cols):
                if current is None or current.conv_id != conv_id:
                    if current is not None:
                        rows.append(finish(current, t))
                    current = _Conversation(conv_id, t)
                    if len(rows) >= 512:
                        yield flush()
                current.add(role, ids, lo, hi)
        if current is not None:
            rows.append(finish(current, t))
        if rows:
            yield flush()
    return run


def _sorted_segments(conversations: DataFrame, path: str, conv_col, turn_col, role_col, text_col) -> DataFrame:
    small_batches(conversations.sparkSession)
    c = lambda n: F.col(f"`{n}`")
    rows = conversations.select(c(conv_col).cast("long").alias("conv_id"), c(turn_col).cast("long").alias("turn"),
                                c(role_col).cast("string").alias("role"), c(text_col).cast("string").alias("text"))
    seg = rows.mapInArrow(_segments(path), "conv_id long, turn long, role string, text string, ids binary, "
                                           "body_from int, body_to int")
    return (seg.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
            .select("conv_id", "role", "ids", "body_from", "body_to"))


def format_chats(conversations: DataFrame, path: str, conv_col="conv_id", turn_col="turn", role_col="role",
                 text_col="text") -> DataFrame:
    """One row per conversation: ``conv_id, n_turns, ids`` (array) and
    ``loss_mask`` (array of booleans of the same length)."""
    def finish(c, t):
        ids, mask = c.done()
        return c.conv_id, len(c.parts) - 1, ids.astype(np.int32).tolist(), mask.tolist()
    return _sorted_segments(conversations, path, conv_col, turn_col, role_col, text_col).mapInArrow(
        _assemble(path, finish, ["conv_id", "n_turns", "ids", "loss_mask"],
                  [pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.bool_())]),
        "conv_id long, n_turns long, ids array<int>, loss_mask array<boolean>")


def read_chats(formatted: DataFrame, path: str) -> DataFrame:
    """Read formatted conversations back: ``conv_id, n_turns, turns`` (array
    of role and text), ``loss_text`` (unescaped, in order) and ``formatted``
    (the whole as text)."""
    def run(batches):
        t = template(path)
        for batch in batches:
            for lo in range(0, len(batch), 256):
                part = batch.slice(lo, 256)
                rows = []
                for ids, mask in zip(part.column(1).to_pylist(), part.column(2).to_pylist()):
                    turns = t.read_back(ids)
                    loss, run_ids = [], []
                    for i, m in zip([*ids, t.end], [*mask, False]):
                        if m:
                            run_ids.append(i)
                        elif run_ids:
                            loss.append(unescape(t.bpe.decode(run_ids)))
                            run_ids = []
                    rows.append((len(turns), [{"role": r, "text": x} for r, x in turns], "".join(loss), t.render(ids)))
                kind = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *[pa.array(c, k) for c, k in
                                       zip(zip(*rows), [pa.int64(), kind, pa.string(), pa.string()])]],
                    names=["conv_id", "n_turns", "turns", "loss_text", "formatted"])
    return formatted.select("conv_id", "ids", "loss_mask").mapInArrow(
        run, "conv_id long, n_turns long, turns array<struct<role:string,text:string>>, loss_text string, "
             "formatted string")
