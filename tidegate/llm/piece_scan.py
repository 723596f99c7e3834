"""SentencePiece encoding and decoding with a max-plus scan for giant documents.

A text is encoded as the pieces of largest total score. Short documents are solved whole,
each different word once, the new words of a run all in step. A giant one is split into
chunks; a chunk yields a matrix of best scores from every way a piece may reach into it to
every way one may reach out of it. Where all paths of a chunk meet, its matrix is a column
plus a row, and only those two are kept. Matrices combine associatively, in groups of
bounded size, level by level; going back down fixes how the best path crosses each border,
and every chunk is then traced back by itself.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidegate.llm.common import pieces, prepare, text_buffer, with_key
from tidegate.llm.segments import SegmentIds, end_to_end, ranges, release_memory
from tidegate.session import materialize

#: Characters of a chunk, and matrices combined at once.
CHUNK, FAN = 8192, 64
MARK = "▁"
#: Scores below this count as this: no path of other pieces over the same text is worse.
FLOOR = -1_000_000
#: What stands for no path, and the score of a character without a piece.
NONE, UNKNOWN = -(1 << 60), 2 * FLOOR
#: Chunks handled by one round of array operations.
TOGETHER = 128
#: Characters up to which texts are solved in step, and characters of them in one round.
SHORT, IN_STEP = 64, 1 << 16


class Model:
    """Pieces and integer weights of a model file.

    A weight is the score in 64ths, with 12 bits of the piece's hash below it, so that
    sums are exact and ties are broken alike in chunks and in whole texts.
    """

    def __init__(self, path: str) -> None:
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.pieces: dict[str, tuple[int, int]] = {}
        self.bytes: dict[int, int] = {}
        plain: list[bytes] = []
        for i in range(sp.get_piece_size()):
            piece = sp.id_to_piece(i)
            text = b""
            if sp.is_byte(i):
                value = int(piece[3:5], 16)
                self.bytes[value] = i
                text = bytes([value])
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                self.pieces[piece] = (i, weight(sp.get_score(i), zlib.crc32(piece.encode())))
                text = piece.replace(MARK, " ").encode()
            plain.append(text)
        self.reach = max(map(len, self.pieces))
        # No piece goes on behind a text that begins none.
        self.beginnings = {p[:n] for p in self.pieces for n in range(1, len(p) + 1)}
        self.joined = {p[i : i + 2] for p in self.pieces for i in range(len(p) - 1)}
        self.unknown = weight(UNKNOWN, 0)
        self.sizes = np.fromiter(map(len, plain), np.int64, len(plain))
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.flat = np.frombuffer(b"".join(plain), np.uint8)
        self.may_cut = np.ones((256, 256), bool)
        for piece in self.pieces:
            for written in (piece.encode(), piece.replace(MARK, " ").encode()):
                own = np.frombuffer(written, np.uint8)
                self.may_cut[own[:-1], own[1:]] = False
        self.may_cut[:, 0x80:0xC0] = False
        # An id's share in the weight of a path; a character without a piece counts at its first byte.
        self.weights = np.zeros(len(plain), np.int64)
        for i, w in self.pieces.values():
            self.weights[i] = w
        for byte, i in self.bytes.items():
            self.weights[i] = 0 if 0x80 <= byte < 0xC0 else self.unknown
        self.index_beginnings()
        self.memo = SegmentIds(self.segments)

    def index_beginnings(self) -> None:
        """Number the beginnings of pieces (0: the empty one) and the characters in them (0: in
        none); `keys` are number * characters + character, `then` the beginning one gets to."""
        number = {b: i for i, b in enumerate(sorted(self.beginnings), 1)} | {"": 0}
        letters = sorted(set("".join(self.pieces)))
        code = {c: i for i, c in enumerate(letters, 1)}
        self.letter = np.zeros(0x110000, np.int32)
        self.letter[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
        self.letters = len(letters) + 1
        keys = np.array([number[b[:-1]] * self.letters + code[b[-1]] for b in self.beginnings], np.int64)
        order = np.argsort(keys)
        self.keys, self.then = keys[order], np.array([number[b] for b in self.beginnings], np.int32)[order]
        self.ended = np.full(len(number), NONE, np.int64)
        self.ended_id = np.full(len(number), -1, np.int32)
        for piece, (i, w) in self.pieces.items():
            self.ended[number[piece]], self.ended_id[number[piece]] = w, i

    def forward(self, text: str, first: int, stop: int):
        """Best weight to each place from first on, with pieces that start before stop, and
        the start and id of the piece that gets there (id -1: a character without one)."""
        best = [NONE] * (len(text) + 1)
        back = [(0, -1)] * (len(text) + 1)
        best[first] = 0
        get, reach, end, beginnings = self.pieces.get, self.reach, len(text), self.beginnings
        for at in range(first, stop):
            here = best[at]
            if here == NONE:
                continue
            for to in range(at + 1, min(at + reach, end) + 1):
                part = text[at:to]
                if part not in beginnings:
                    break
                found = get(part)
                if found is not None and here + found[1] > best[to]:
                    best[to], back[to] = here + found[1], (at, found[0])
            if here + self.unknown > best[at + 1]:
                best[at + 1], back[at + 1] = here + self.unknown, (at, -1)
        return best, back

    def trace(self, text: str, back, first: int, last: int) -> list[int]:
        parts = []
        at = last
        while at > first:
            start, piece = back[at]
            if piece < 0:
                parts.append([self.bytes[b] for b in text[start:at].encode("utf-8", "surrogatepass")])
            else:
                parts.append([piece])
            at = start
        return [i for part in reversed(parts) for i in part]

    def best_ids(self, text: str) -> list[int]:
        _, back = self.forward(text, 0, len(text))
        return self.trace(text, back, 0, len(text))

    def onward(self, text: str) -> list[int]:
        """Best weight from each place to the end of the text."""
        get, reach, end, beginnings = self.pieces.get, self.reach, len(text), self.beginnings
        best = [0] * (end + 1)
        for at in range(end - 1, -1, -1):
            here = best[at + 1] + self.unknown
            for to in range(at + 1, min(at + reach, end) + 1):
                part = text[at:to]
                if part not in beginnings:
                    break
                found = get(part)
                if found is not None and best[to] + found[1] > here:
                    here = best[to] + found[1]
            best[at] = here
        return best

    def in_step(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """best_ids of texts with characters, longest first: (ids end to end, number of each).

        A text takes a row per place in it, the end included; its paths never touch the
        next one's, as no piece goes over the row of an end.
        """
        reach = self.reach
        length = np.fromiter(map(len, texts), np.int64, len(texts))
        points = np.frombuffer("\n".join(["", *texts, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)[1:]
        points = np.concatenate([np.zeros(reach, np.uint32), points])
        end = reach + np.cumsum(length + 1) - 1
        base = end - length
        letter = self.letter[points]
        letter[end] = 0
        letter[:reach] = 0
        # By the place where a piece ends, longest piece first: of equal sums that one stands.
        weight = np.full((points.size, reach), NONE, np.int64)
        piece = np.full((points.size, reach), -1, np.int32)
        at, state = np.arange(reach, points.size), np.zeros(points.size - reach, np.int64)
        inside = np.ones(points.size, bool)
        inside[end] = False
        weight[np.flatnonzero(inside[reach:]) + reach + 1, reach - 1] = self.unknown
        for n in range(1, reach + 1):
            key = state * self.letters + letter[at + n - 1]
            found = np.minimum(np.searchsorted(self.keys, key), self.keys.size - 1)
            hit = self.keys[found] == key
            at, state = at[hit], self.then[found[hit]].astype(np.int64)
            if not at.size:
                break
            whole = self.ended[state] >= weight[at + n, reach - n]
            to = at[whole] + n
            weight[to, reach - n], piece[to, reach - n] = self.ended[state[whole]], self.ended_id[state[whole]]
        best = np.zeros(points.size, np.int64)
        step = np.zeros(points.size, np.int64)
        before = np.lib.stride_tricks.sliding_window_view(best, reach)
        for place in range(1, int(length[0]) + 1):
            to = base[: np.searchsorted(-length, -place, "right")] + place
            sums = before[to - reach] + weight[to]
            top = sums.argmax(1)
            best[to] = sums[np.arange(to.size), top]
            step[to] = reach - top
        ends = np.zeros(points.size, bool)
        to, first = end, base
        while to.size:
            ends[to] = True
            to = to - step[to]
            left = to > first
            to, first = to[left], first[left]
        to = np.flatnonzero(ends)
        ids, text = piece[to, reach - step[to]].astype(np.int64), np.searchsorted(end, to)
        unknown = np.flatnonzero(ids < 0)
        if unknown.size:
            raw = [chr(c).encode("utf-8", "surrogatepass") for c in points[to[unknown] - 1].tolist()]
            many = np.ones(ids.size, np.int64)
            many[unknown] = list(map(len, raw))
            start = np.cumsum(many) - many
            ids, text = np.repeat(ids, many), np.repeat(text, many)
            ids[ranges(start[unknown], many[unknown])] = [self.bytes[b] for b in b"".join(raw)]
        return ids.astype(np.uint32), np.bincount(text, minlength=length.size)

    def segments(self, raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of segments end to end, number of each)."""
        texts = [s.decode().replace(" ", MARK) for s in raw]
        length = np.fromiter(map(len, texts), np.int64, len(texts))
        order = np.argsort(-length, kind="stable")
        n_long = int((length > SHORT).sum())
        found = [end_to_end([self.best_ids(texts[i]) for i in order[:n_long]])]
        places = np.concatenate([[0], np.cumsum(length[order[n_long:]] + 1)])
        for first, last in pieces(places, IN_STEP):
            found.append(self.in_step([texts[i] for i in order[n_long + first : n_long + last]]))
        ids, sizes = (np.concatenate(x) for x in zip(*found))
        start, back = np.cumsum(sizes) - sizes, np.argsort(order)
        return ids[ranges(start[back], sizes[back])], sizes[back]

    def encode(self, data: np.ndarray, offsets: np.ndarray):
        """Ids of texts that each begin with the blank that the model puts before a text.

        A text may be cut between two bytes that stand side by side in no piece.
        """
        cut = np.zeros(data.size, bool)
        cut[1:] = self.may_cut[data[:-1], data[1:]]
        return self.memo.encode(data, offsets, cut)

    def forget(self) -> None:
        self.memo.forget()

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of ids in order."""
        size = self.sizes[ids]
        total = np.cumsum(size)
        if not total.size:
            return np.zeros(0, np.uint8)
        return self.flat[np.repeat(self.starts[ids] - (total - size), size) + np.arange(total[-1])]

    def matrix(self, text: str, own: int) -> np.ndarray:
        """Best weights of a chunk whose own characters are the first `own` of text: from
        the character where its first piece starts to how far its last one reaches over."""
        out = np.full((self.reach, self.reach), NONE, np.int64)
        for first in range(min(self.reach, own + 1)):
            best, _ = self.forward(text, first, own)
            for over in range(min(self.reach, len(text) - own + 1)):
                out[first, over] = best[own + over]
        # A piece may also reach across a chunk that is shorter than it.
        for first in range(own, self.reach):
            out[first] = NONE
            out[first, first - own] = 0
        return out


def weight(score: float, tie: int) -> int:
    return (round(max(score, UNKNOWN if score == UNKNOWN else FLOOR) * 64) << 12) + (tie & 0xFFF)


_MODELS: dict[str, Model] = {}


def model_of(path: str) -> Model:
    if path not in _MODELS:
        _MODELS[path] = Model(path)
    return _MODELS[path]


def max_plus(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Product of matrices where sums are maxima and products are sums."""
    return np.maximum((a[:, :, None] + b[None, :, :]).max(1), NONE)


def as_matrix(raw: bytes, reach: int) -> np.ndarray:
    """A stored matrix; two rows stand for the matrix of every entry of one plus every entry
    of the other."""
    return np.frombuffer(raw, np.int64).reshape(-1, reach)


def spread(a: np.ndarray) -> np.ndarray:
    """The whole matrix of a stored one."""
    return a if a.shape[0] == a.shape[1] else np.maximum(a[0][:, None] + a[1][None, :], NONE)


def combined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """max_plus of stored matrices, stored."""
    whole_a, whole_b = a.shape[0] == a.shape[1], b.shape[0] == b.shape[1]
    if whole_a and whole_b:
        return max_plus(a, b)
    if whole_a:
        out = (a + b[0][None, :]).max(1), b[1]
    elif whole_b:
        out = a[0], (a[1][:, None] + b).max(0)
    else:
        out = a[0] + (a[1] + b[0]).max(), b[1]
    return np.maximum(np.stack(out), NONE)


def crossings(spark: SparkSession, matrices: DataFrame, reach: int) -> DataFrame:
    """(doc_id, tie, chunk, enter, leave): how the best path crosses the chunks' borders.

    matrices has doc_id, tie, chunk (dense from 0) and matrix. Groups hold FAN rows at
    most; the number of levels is the logarithm of the largest chunk number.
    """
    levels = [matrices]
    largest = matrices.agg(F.max("chunk")).first()[0] or 0

    def blocks(level: DataFrame) -> DataFrame:
        return level.groupBy("doc_id", "tie", F.expr(f"chunk div {FAN}").alias("block")).agg(
            F.sort_array(F.collect_list(F.struct("chunk", "matrix"))).alias("rows")
        )

    def steps_of(batch: pa.RecordBatch):
        for rows in batch.column("rows"):
            yield rows.values.field("chunk"), [as_matrix(m.as_buffer(), reach) for m in rows.values.field("matrix")]

    def up(batches):
        for batch in batches:
            totals = []
            for _, steps in steps_of(batch):
                total = steps[0]
                for step in steps[1:]:
                    total = combined(total, step)
                totals.append(total.tobytes())
            columns = [*(batch.column(c) for c in ("doc_id", "tie", "block")), pa.array(totals, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "tie", "chunk", "matrix"])

    while largest > 0:
        done = blocks(levels[-1]).mapInArrow(up, "doc_id long, tie long, chunk long, matrix binary")
        levels.append(materialize(spark, done, "scan-up"))
        largest //= FAN

    def down(batches):
        for batch in batches:
            chunks, states, sizes = [], [], []
            for (chunk, steps), enter, leave in zip(
                steps_of(batch), batch.column("enter").to_pylist(), batch.column("leave").to_pylist()
            ):
                steps = [spread(s) for s in steps]
                reached = [np.full(reach, NONE, np.int64)]
                reached[0][enter] = 0
                for step in steps:
                    reached.append(np.maximum((reached[-1][:, None] + step).max(0), NONE))
                path = [leave]
                for step, vector in zip(reversed(steps), reversed(reached[:-1])):
                    path.append(int((vector + step[:, path[-1]]).argmax()))
                path.reverse()
                chunks.append(chunk)
                states += zip(path[:-1], path[1:])
                sizes.append(len(steps))
            if sizes:
                owner = pa.array(np.repeat(np.arange(len(sizes)), sizes))
                entered, left = (pa.array(x, pa.int32()) for x in zip(*states))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(owner), batch.column("tie").take(owner), pa.concat_arrays(chunks),
                     entered, left],
                    ["doc_id", "tie", "chunk", "enter", "leave"],
                )

    state = levels[-1].select("doc_id", "tie", "chunk", F.lit(0).alias("enter"), F.lit(0).alias("leave"))
    for level in reversed(levels[:-1]):
        placed = blocks(level).join(state.withColumnRenamed("chunk", "block"), ["doc_id", "tie", "block"])
        state = materialize(
            spark, placed.mapInArrow(down, "doc_id long, tie long, chunk long, enter int, leave int"), "scan-down"
        )
    return state


def encode_pieces(spark: SparkSession, docs: DataFrame, path: str, chunk: int = CHUNK) -> DataFrame:
    """doc_id, tie, n_chars, ids (array of int): the best pieces of every text.

    As the model file asks, a blank goes before each text and blanks become marks;
    characters without a piece become their bytes. Null texts are empty and have no ids.
    Documents over `chunk` characters are split, and many tasks make the matrices of one;
    its row, which holds all its ids, is put together in one task, chunk after chunk. A
    repeated row comes back as often as it came in; null ids stay. Other columns are ignored.
    """
    prepare(spark)
    keyed = with_key(docs)
    reach = model_of(path).reach
    giant = F.char_length(F.coalesce("text", F.lit(""))) > chunk

    def forgetting(work):
        """The same work, whose memos are freed when the task ends."""

        def run(batches):
            try:
                yield from work(batches)
            finally:
                model_of(path).forget()
                release_memory()

        return run

    @forgetting
    def whole(batches):
        model = model_of(path)
        for batch in batches:
            texts = [" " + t if t else "" for t in batch.column("text").to_pylist()]
            data, offsets = text_buffer(pa.array(texts, pa.large_string()))
            for first, last in pieces(offsets, 1 << 20):
                part = data[offsets[first] : offsets[last]]
                ids, starts = model.encode(part, offsets[first : last + 1] - offsets[first])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(first, last - first), batch.column("tie").slice(first, last - first),
                     pa.array([max(len(t) - 1, 0) for t in texts[first:last]], pa.int64()),
                     pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(ids.astype(np.int32)))],
                    ["doc_id", "tie", "n_chars", "ids"],
                )

    def bodies(text: str, first: int):
        """(body, own characters) of up to TOGETHER chunks from the first-th on."""
        places = range(first * chunk, min(len(text), (first + TOGETHER) * chunk), chunk)
        return [(text[at : at + chunk + reach - 1], min(chunk, len(text) - at)) for at in places]

    def split(batches):
        for batch in batches:
            for nth, (doc_id, tie, text) in enumerate(zip(*(batch.column(c) for c in ("doc_id", "tie", "text")))):
                text = " " + text.as_py()
                for first in range(0, -(-len(text) // chunk), TOGETHER):
                    part = bodies(text, first)
                    same = lambda value: pa.array([value] * len(part), pa.int64())  # noqa: B023, E731
                    yield pa.RecordBatch.from_arrays(
                        [same(doc_id.as_py()), same(tie.as_py()), pa.array(range(first, first + len(part)), pa.int64()),
                         same(nth), pa.array([n for _, n in part], pa.int64()), pa.array([b for b, _ in part], pa.string())],
                        ["doc_id", "tie", "chunk", "nth", "own", "body"],
                    )

    schema = "doc_id long, tie long, n_chars long, ids array<int>"
    short = keyed.where(~giant).mapInArrow(whole, schema)
    # The number in its batch spreads a row that is often repeated.
    chunks = keyed.where(giant).mapInArrow(
        split, "doc_id long, tie long, chunk long, nth long, own long, body string"
    ).repartition("doc_id", "tie", "chunk", "nth")

    @forgetting
    def transfer(batches):
        model = model_of(path)
        for batch in batches:
            for first in range(0, batch.num_rows, TOGETHER):
                part = batch.slice(first, TOGETHER)
                found = chunk_matrices(model, list(zip(part.column("body").to_pylist(), part.column("own").to_pylist())))
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in ("doc_id", "tie", "chunk")), pa.array([m.tobytes() for m in found], pa.binary())],
                    ["doc_id", "tie", "chunk", "matrix"],
                )

    matrices = chunks.mapInArrow(transfer, "doc_id long, tie long, chunk long, matrix binary")
    matrices = materialize(spark, matrices.dropDuplicates(["doc_id", "tie", "chunk"]), "scan-matrices")
    states = crossings(spark, matrices, reach).groupBy("doc_id", "tie").agg(
        F.sort_array(F.collect_list(F.struct("chunk", "enter", "leave"))).alias("states")
    )

    @forgetting
    def traced(batches):
        model = model_of(path)
        for batch in batches:
            for doc_id, tie, text, crossed in zip(*(batch.column(c) for c in ("doc_id", "tie", "text", "states"))):
                text = " " + text.as_py()
                enter, leave = (crossed.values.field(c).to_numpy(zero_copy_only=False) for c in ("enter", "leave"))
                found = []
                for first in range(0, enter.size, TOGETHER):
                    some = slice(first, first + TOGETHER)
                    found.append(chunks_ids(model, bodies(text, first), enter[some].tolist(), leave[some].tolist()))
                ids = np.concatenate(found)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([doc_id.as_py()], pa.int64()), pa.array([tie.as_py()], pa.int64()),
                     pa.array([len(text) - 1], pa.int64()),
                     pa.ListArray.from_arrays(pa.array([0, ids.size], pa.int32()), pa.array(ids.astype(np.int32)))],
                    ["doc_id", "tie", "n_chars", "ids"],
                )

    # Merged at every size: broadcast, the states of all giant texts would lie in the driver.
    long = keyed.where(giant).join(states.hint("merge"), ["doc_id", "tie"]).select("doc_id", "tie", "text", "states")
    return short.unionByName(long.mapInArrow(traced, schema))


class Chunk:
    """A chunk's bytes, and the places in its own characters before which every path is cut:
    between two bytes that stand side by side in no piece."""

    def __init__(self, model: Model, body: str, own: int) -> None:
        self.body, self.own, self.raw = body, own, body.encode("utf-8", "surrogatepass")
        data = np.frombuffer(self.raw, np.uint8)
        self.first_bytes = np.append(np.flatnonzero((data & 0xC0) != 0x80), data.size)
        cuts = np.flatnonzero(model.may_cut[data[:-1], data[1:]]) + 1
        self.cuts = np.searchsorted(self.first_bytes, cuts[cuts < self.first_bytes[own]])

    def between(self, first: int, last: int) -> bytes:
        return self.raw[self.first_bytes[first] : self.first_bytes[last]]

    def written(self, first: int, last: int | None = None) -> str:
        return self.body[first:last].replace(" ", MARK)


def middle_ids(model: Model, parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(ids, starts) of parts of texts that every path enters and leaves at their ends."""
    return model.encode(
        np.frombuffer(b"".join(parts), np.uint8), np.concatenate([[0], np.cumsum(list(map(len, parts)))]).astype(np.int64)
    )


def chunk_matrices(model: Model, bodies: list[tuple[str, int]]) -> list[np.ndarray]:
    """The matrices of chunks as stored: between the first and the last cut all paths are one,
    so only the ends need every entry and every exit."""
    reach = model.reach
    chunks = [Chunk(model, body, own) for body, own in bodies]
    ends = [c.cuts[c.cuts >= reach][[0, -1]].tolist() if c.cuts.size and c.cuts[-1] >= reach else None for c in chunks]
    ids, starts = middle_ids(model, [c.between(*e) if e else b"" for c, e in zip(chunks, ends)])
    middle = np.diff(np.concatenate([[0], np.cumsum(model.weights[ids])])[starts])
    out = []
    for c, end, weight_between in zip(chunks, ends, middle.tolist()):
        if end is None or reach < 3:
            out.append(model.matrix(c.written(0), c.own))
            continue
        first, last = end
        head = np.array(model.onward(c.written(0, first))[:reach], np.int64) + weight_between
        best, _ = model.forward(c.written(last), 0, c.own - last)
        tail = np.full(reach, NONE, np.int64)
        over = min(reach, len(c.body) - c.own + 1)
        tail[:over] = best[c.own - last : c.own - last + over]
        out.append(np.stack([head, tail]))
    return out


def chunks_ids(model: Model, bodies: list[tuple[str, int]], enter: list[int], leave: list[int]) -> np.ndarray:
    """Ids of the pieces that start in each chunk on its path from enter to leave, in order."""
    parts, tails = [], []
    for (body, own), come, go in zip(bodies, enter, leave):
        if come >= own:  # a piece reaches across
            parts.append(b"")
            tails.append([])
            continue
        c = Chunk(model, body, own)
        # Up to the last cut, or the border itself, the path runs inside the chunk.
        last = own if go == 0 else max(come, int(c.cuts[-1]) if c.cuts.size else 0)
        parts.append(c.between(come, last))
        tail = c.written(last)
        tails.append(model.trace(tail, model.forward(tail, 0, own - last)[1], 0, own + go - last) if go else [])
    ids, starts = middle_ids(model, parts)
    return np.concatenate([
        x for first, last, tail in zip(starts[:-1], starts[1:], tails) for x in (ids[first:last], np.array(tail, np.uint32))
    ])


def decode_pieces(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id, tie and decoded: the text of ids, without the blank put before it. Marks in the
    original come back as blanks, as they have no ids of their own."""

    def run(batches):
        model = model_of(path)
        for batch in batches:
            out = []
            for ids in batch.column("ids"):
                values = ids.values.to_numpy(zero_copy_only=False) if ids.values is not None else np.zeros(0, np.int64)
                out.append(model.decode(values).tobytes()[1:].decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("tie"), pa.array(out, pa.string())], ["doc_id", "tie", "decoded"]
            )

    return encoded.select("doc_id", "tie", "ids").mapInArrow(run, "doc_id long, tie long, decoded string")


def encoding_digests(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id, n_chars, n_tokens, ids_crc32 (little-endian unsigned 32-bit ids), decoded_sha256."""

    def run(batches):
        model = model_of(path)
        for batch in batches:
            rows = [[], [], []]
            for ids in batch.column("ids"):
                values = ids.values.to_numpy(zero_copy_only=False) if ids.values is not None else np.zeros(0, np.int64)
                rows[0].append(len(values))
                rows[1].append(zlib.crc32(values.astype("<u4").tobytes()))
                rows[2].append(hashlib.sha256(model.decode(values).tobytes()[1:]).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_chars"), *(pa.array(r) for r in rows)],
                ["doc_id", "n_chars", "n_tokens", "ids_crc32", "decoded_sha256"],
            )

    out = encoded.mapInArrow(
        run, "doc_id long, n_chars long, n_tokens long, ids_crc32 long, decoded_sha256 string"
    )
    return out.withColumn("doc_id", F.when(F.col("doc_id") != F.lit(-(1 << 63)), F.col("doc_id")))
