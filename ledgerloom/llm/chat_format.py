"""Chat turns as token sequences with reserved control ids and a loss mask.

A turn is ``<turn>`` role ``<says>`` text ``</turn>``; the three control strings have ids of their own, past the
vocabulary.  Role and text are encoded apart from them, so no content can make a control id, and control strings that
occur in content are escaped in the written form: a backslash goes in after their ``<``, one more if some stand there.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.packing import encoder
from ledgerloom.llm.store import dropped, written

CONTROLS = ("<turn>", "<says>", "</turn>")
LEARNED_ROLE = "assistant"

_TO_ESCAPE = re.compile(r"<(\\*)(/?turn>|says>)")
_ESCAPED = re.compile(r"<(\\*)\\(/?turn>|says>)")

PIECE = 1 << 20  # bytes of a conversation's texts that a task holds before it writes them

FORMATTED = "conv_id long, turn long, role string, text string, formatted string, ids array<int>, loss_mask array<boolean>"

_READ = "conv_id long, turn long, role string, text string, loss string, formatted_chars long"
_DIGEST = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
_PARTS = f"{_DIGEST}, part int, nth int, turns binary, loss binary"
_PARTS_SCHEMA = pa.schema(
    [("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())]
    + [("part", pa.int32()), ("nth", pa.int32()), ("turns", pa.binary()), ("loss", pa.binary())]
)


def escape(text: str) -> str:
    return _TO_ESCAPE.sub(r"<\1\\\2", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1\2", text)


@functools.cache
def _tokenizer(path: str) -> tuple[Callable[[str], list[int]], Callable[[list[int]], str], int]:
    """Encoder, decoder and first free id of a vocabulary, read once a worker; special tokens' strings are ordinary text."""
    found = encoder(path)
    base = found.tokenizer.get_vocab_size(with_added_tokens=True)
    if found.ranks is not None:
        return found.ranks.encode_ordinary, found.ranks.decode, base
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(path)
    own.encode_special_tokens = True
    return lambda text: own.encode(text, add_special_tokens=False).ids, lambda ids: own.decode(ids, skip_special_tokens=False), base


def _format(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, _, base = _tokenizer(path)
        for whole in batches:
            for at in range(0, len(whole), 512):
                batch = whole.slice(at, 512)
                roles = [r or "" for r in batch.column("role").to_pylist()]
                texts = [t or "" for t in batch.column("text").to_pylist()]
                escaped = [(escape(r), escape(t)) for r, t in zip(roles, texts)]
                encoded = [encode(s) for pair in escaped for s in pair]
                segments: list[list[int]] = []
                learned: list[bool] = []
                for i, role in enumerate(roles):
                    segments += [[base], encoded[2 * i], [base + 1], encoded[2 * i + 1], [base + 2]]
                    learned += [False, False, False, role == LEARNED_ROLE, False]
                ends = np.cumsum([len(s) for s in segments])
                ids = np.fromiter((i for s in segments for i in s), dtype=np.int32, count=int(ends[-1]) if len(ends) else 0)
                change = np.zeros(len(ids) + 1, dtype=np.int64)
                starts = np.concatenate(([0], ends[:-1])) if len(ends) else ends
                np.add.at(change, starts[learned], 1)
                np.add.at(change, ends[learned], -1)
                mask = np.cumsum(change[:-1]) > 0
                offsets = pa.array(np.concatenate(([0], ends[4::5])), pa.int32())
                written = [f"{CONTROLS[0]}{r}{CONTROLS[1]}{t}{CONTROLS[2]}" for r, t in escaped]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("conv_id"), batch.column("turn"), pa.array(roles), pa.array(texts), pa.array(written),
                        pa.ListArray.from_arrays(offsets, pa.array(ids)), pa.ListArray.from_arrays(offsets, pa.array(mask)),
                    ],
                    names=["conv_id", "turn", "role", "text", "formatted", "ids", "loss_mask"],
                )

    return run


def format_chats(turns: DataFrame, tokenizer_path: str) -> DataFrame:
    """One row per turn of ``turns`` (conv_id, turn, role, text): its written form, ids and loss mask.

    A conversation is its turns' rows one after another, by turn, then role, then text (nulls first); each row stands on
    its own, so a conversation of any length is never held together.  Null roles and texts are empty.  The mask covers
    the ids of the texts of role ``assistant``, and nothing else.  An empty table gives an empty result; repeated rows
    are repeated turns.
    """
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_format(tokenizer_path), FORMATTED)


def _read_back(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, decode, base = _tokenizer(path)
        for whole in batches:
            for at in range(0, len(whole), 512):
                batch = whole.slice(at, 512)
                contents: list[list[int]] = []
                for ids, mask in zip(batch.column("ids").to_pylist(), batch.column("loss_mask").to_pylist()):
                    says = ids.index(base + 1)
                    if ids[0] != base or ids[-1] != base + 2:
                        raise ValueError("a turn is not closed by its control ids")
                    contents += [ids[1:says], ids[says + 1 : -1], [i for i, m in zip(ids, mask) if m]]
                decoded = [unescape(decode(c)) for c in contents]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("conv_id"), batch.column("turn"), *(pa.array(decoded[k::3], pa.string()) for k in range(3)), pa.array([len(f) for f in batch.column("formatted").to_pylist()], pa.int64())],
                    names=["conv_id", "turn", "role", "text", "loss", "formatted_chars"],
                )

    return run


class _Run:
    """What one partition holds of a conversation: what is not yet written of its texts, and counts of that."""

    def __init__(self, key: int | None):
        self.key, self.nth, self.turns, self.loss, self.counts = key, 0, [], [], [0, 0, 0, 0]

    def add(self, role: str, text: str, loss: str, formatted_chars: int) -> None:
        turn, learned = f"{role}\n{text}\n".encode(), loss.encode()
        self.turns.append(turn)
        self.loss.append(learned)
        for i, more in enumerate((1, len(loss), formatted_chars, len(turn) + len(learned))):
            self.counts[i] += more

    def row(self, part: int, whole: bool) -> tuple:
        """Digests of a whole conversation, or the next piece of one whose other pieces lie elsewhere."""
        turns, loss = b"".join(self.turns), b"".join(self.loss)
        n, loss_chars, formatted_chars, _ = self.counts
        nth = self.nth
        self.nth, self.turns, self.loss, self.counts = nth + 1, [], [], [0, 0, 0, 0]
        if whole:
            return self.key, n, hashlib.sha256(turns).hexdigest(), loss_chars, hashlib.sha256(loss).hexdigest(), formatted_chars, part, nth, None, None
        return self.key, n, None, loss_chars, None, formatted_chars, part, nth, turns, loss


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order to digests of the conversations that lie inside the partition, and pieces of PIECE bytes or one text
    of the others: the first and the last one, which may go on in the neighbours, and long ones."""
    part, run, first = TaskContext.get().partitionId(), None, True

    def table(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _PARTS_SCHEMA)], schema=_PARTS_SCHEMA)

    for batch in batches:
        done = []
        for key, _, *turn in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "loss", "formatted_chars"))):
            if run is None or key != run.key:
                if run is not None:
                    done.append(run.row(part, whole=not first and run.nth == 0))
                    first = False
                run = _Run(key)
            run.add(*turn)
            if run.counts[3] >= PIECE:
                yield table([run.row(part, whole=False)])
        if done:
            yield table(done)
    if run is not None:
        yield table([run.row(part, whole=False)])


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces in order to digests; only the running digests are kept."""
    conv, state, begun = None, None, False
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def table(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 6, kinds)], names=[f.name for f in list(_PARTS_SCHEMA)[:6]])

    def row() -> tuple:
        return conv, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]

    for batch in batches:
        done = []
        for key, n, turns, loss_chars, loss, formatted_chars in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "n_turns", "turns", "loss_chars", "loss", "formatted_chars"))):
            if not begun or key != conv:
                if begun:
                    done.append(row())
                conv, state, begun = key, [0, hashlib.sha256(), 0, hashlib.sha256(), 0], True
            state[0] += n
            state[1].update(turns)
            state[2] += loss_chars
            state[3].update(loss)
            state[4] += formatted_chars
        yield table(done)
    if begun:
        yield table([row()])


def conversation_digests(formatted: DataFrame, tokenizer_path: str) -> DataFrame:
    """Per conversation, what its formatted rows say when read back from ids and mask: turn count and digest, length and
    digest of the text under the mask, length of the written form.

    Turns are read back where they stand, then dealt out by ranges of (conversation, turn, role, text), so a conversation
    of any length is spread over tasks.  One that lies inside a range is finished there; the others, and long ones, leave
    pieces, and only their digests' last step, which goes through the bytes in order, has a task of its own.
    """
    spark = formatted.sparkSession
    read = formatted.select("conv_id", "turn", "ids", "loss_mask", "formatted").mapInArrow(_read_back(tokenizer_path), _READ)
    read, read_path = written(read, "read-back")
    dealt = read.repartitionByRange("conv_id", "turn", "role", F.substring("text", 1, 64)).sortWithinPartitions("conv_id", "turn", "role", "text")
    parts, _ = written(dealt.mapInArrow(_runs, _PARTS), "conversation-parts")
    dropped(spark, read_path)
    pieces = parts.where("turns_sha256 is null").repartition("conv_id").sortWithinPartitions("conv_id", "part", "nth")
    inside = parts.where("turns_sha256 is not null")
    columns = [c.split()[0] for c in _DIGEST.split(", ")]
    return inside.select(*columns).unionByName(pieces.mapInArrow(_joined, _DIGEST))
