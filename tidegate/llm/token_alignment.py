"""Alignment of two tokenizers over the corpus: which ids of one lie over which of the other.

A text is encoded whole by both. Where both have a token's end and both next tokens begin
with a blank, and where the text ends, stands an anchor; the ids between two anchors are a
window. Windows are named by their ids, and each different window is aligned once.

A row of the stored table is a run of texts: numbers per text, the windows of its texts
in order, and the links of its different windows. Counts of id pairs are summed up per task,
then over tasks. The pairs of the highest counts and the best count of every id are
broadcast, which two parameters bound; the other pairs reach their links by a join.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession, functions as F
from tokenizers import Tokenizer

from tidegate.llm.byte_bpe import byte_characters, byte_level_encoder
from tidegate.llm.column_packing import byte_level_cuts
from tidegate.llm.common import pieces, prepare, text_buffer
from tidegate.llm.segments import ByteMemo, GrowingLists, SegmentIds, ranges, release_memory, runs_of, strings_of
from tidegate.session import materialize

#: Bytes handed to a worker at once, and bytes of text handled together.
BATCH_BYTES = 4 << 20
RUN_BYTES = 1 << 19
#: Pairs whose counts are broadcast, at most.
BROADCAST_PAIRS = 262_144
STEPS_PER_DOUBLING = 16
#: Bytes that the memo of windows and each memo of segments hold.
WINDOW_MEMO_BYTES, SEGMENT_MEMO_BYTES = 16 << 20, 20 << 20
#: Windows whose text is hashed at once.
HASHED_TOGETHER = 1 << 18
SPACE_MARK = "▁"


# --- the two vocabularies ---------------------------------------------------------


class Side:
    """Ids of whole texts by one tokenizer, and the bytes of every id."""

    def __init__(self, token_bytes: list[bytes], tokenize, cuts) -> None:
        self.token_bytes = token_bytes
        self.length = np.array([len(t) for t in token_bytes], np.int64)
        self.spaced = np.array([t[:1] == b" " for t in token_bytes])
        self.segments = SegmentIds(tokenize, SEGMENT_MEMO_BYTES)
        self.cuts = cuts

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        ids, starts = self.segments.encode(data, offsets, self.cuts(data, offsets))
        return ids.astype(np.int64), starts

    def same_bytes(self, ids: np.ndarray, starts: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Whether the joined bytes of every text's tokens are the text's."""
        flat, places = self.flat()
        size = self.length[ids]
        total = np.concatenate([[0], np.cumsum(size)])[starts]
        length = np.diff(offsets)
        good = np.diff(total) == length
        if not good.all():
            keep = np.repeat(good, np.diff(starts))
            ids, size, data = ids[keep], size[keep], data[np.repeat(good, length)]
        wrong = np.flatnonzero(flat[ranges(places[ids], size)] != data)
        good[np.searchsorted(np.cumsum(length * good), wrong, "right")] = False
        return good

    def flat(self):
        if not hasattr(self, "_flat"):
            self._flat = (
                np.frombuffer(b"".join(self.token_bytes), np.uint8),
                np.concatenate([[0], np.cumsum(self.length)])[:-1],
            )
        return self._flat


def byte_level_side(path: str) -> Side:
    """A byte-level tokenizer file; the strings of special tokens are plain text."""
    of = byte_characters()
    entries = sorted((i, t) for t, i in Tokenizer.from_file(path).get_vocab().items())
    token_bytes = [b""] * (entries[-1][0] + 1)
    for i, t in entries:
        token_bytes[i] = bytes(of[c] for c in t) if all(c in of for c in t) else t.encode()

    return Side(token_bytes, byte_level_encoder(path, special_as_text=True), byte_level_cuts)


def piece_side(path: str) -> Side:
    """A piece model, given texts that carry their own leading blank.

    A merge joins neighbours only into a piece, so between two bytes that stand side by
    side in no piece the text may be cut without changing its ids.
    """
    from sentencepiece import sentencepiece_model_pb2 as layout

    model = layout.ModelProto()
    with open(path, "rb") as file:
        model.ParseFromString(file.read())
    model.normalizer_spec.add_dummy_prefix = False
    processor = sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())
    token_bytes, may_cut = [], np.ones((256, 256), bool)
    for piece in model.pieces:
        if piece.type == layout.ModelProto.SentencePiece.BYTE:
            token_bytes.append(bytes([int(piece.piece[3:5], 16)]))
            continue
        token_bytes.append(piece.piece.replace(SPACE_MARK, " ").encode())
        for written in (token_bytes[-1], piece.piece.encode()):  # the mark itself may stand in a text
            own = np.frombuffer(written, np.uint8)
            may_cut[own[:-1], own[1:]] = False
    may_cut[:, 0x80:0xC0] = False  # not inside a character

    def cuts(data, offsets):
        cut = np.zeros(data.size, bool)
        cut[1:] = may_cut[data[:-1], data[1:]]
        return cut

    def tokenize(segments):
        return processor.encode([s.decode("utf-8", "replace") for s in segments], num_threads=1)

    return Side(token_bytes, tokenize, cuts)


# --- windows ----------------------------------------------------------------------


class Windows:
    """Alignments of id windows, each different one made once: its groups as text, the
    number of them, and its links as pair codes."""

    def __init__(self, a: Side, b: Side) -> None:
        self.a, self.b = a, b
        self.digits = GrowingLists(np.uint8)
        written = [str(i).encode() for i in range(max(len(a.token_bytes), len(b.token_bytes)))]
        self.digits.extend(np.frombuffer(b"".join(written), np.uint8), np.array(list(map(len, written))))
        self.forget()

    def forget(self) -> None:
        self.memo = ByteMemo(WINDOW_MEMO_BYTES)
        self.texts: list[bytes] = []
        self.groups = GrowingLists()
        self.links = GrowingLists()

    def align(self, ids_a: np.ndarray, ids_b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> None:
        """Add windows, given their ids end to end and how many of each are theirs."""
        end_a, end_b = np.cumsum(self.a.length[ids_a]), np.cumsum(self.b.length[ids_b])
        # Between two neighbouring ends of either side lies one link.
        ends = np.sort(np.concatenate([end_a, end_b]), kind="stable")
        ends = ends[np.diff(ends, prepend=-1) > 0]
        over_a, over_b = np.searchsorted(end_a, ends), np.searchsorted(end_b, ends)
        window = np.repeat(np.arange(n_a.size), n_a)[over_a]
        sizes = np.bincount(window, minlength=n_a.size)
        self.links.extend(ids_a[over_a] * len(self.b.token_bytes) + ids_b[over_b], sizes)
        shared = (end_a[over_a] == ends) & (end_b[over_b] == ends)
        groups = np.bincount(window[shared], minlength=n_a.size)
        self.groups.extend(np.zeros(0, np.int64), groups)
        texts = self.written(ids_a, ids_b, over_a[shared] + 1, over_b[shared] + 1, np.cumsum(groups))
        self.texts.extend(texts)
        self.memo.held += sum(map(len, texts)) + 8 * int(sizes.sum())

    def written(self, ids_a, ids_b, to_a: np.ndarray, to_b: np.ndarray, last: np.ndarray) -> list[bytes]:
        """The groups of each window as text: to_a and to_b are where groups end, last is
        the number of groups up to each window's end."""
        n_a, n_b = np.diff(to_a, prepend=0), np.diff(to_b, prepend=0)
        # Ids in order of writing: of every group those of A, then those of B.
        place_a = np.arange(ids_a.size) + np.repeat(to_b - n_b, n_a)
        place_b = np.arange(ids_b.size) + np.repeat(to_a, n_b)
        ids = np.empty(ids_a.size + ids_b.size, np.int64)
        ids[place_a], ids[place_b] = ids_a, ids_b
        behind = np.full(ids.size, ord(","), np.uint8)
        behind[place_a[to_a - 1]] = ord("|")
        behind[place_b[to_b - 1]] = ord(";")
        size = self.digits.sizes[ids] + 1
        end = np.cumsum(size)
        flat = np.empty(int(end[-1]), np.uint8)
        flat[end - 1] = behind
        flat[ranges(end - size, size - 1)] = self.digits.take(ids)[0]
        edge = np.concatenate([[0], end[place_b[to_b[last - 1] - 1]]])
        text = flat.tobytes()
        return [text[x : y - 1] for x, y in zip(edge[:-1].tolist(), edge[1:].tolist())]

    def find(self, ids_a: np.ndarray, ids_b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(code of each window, slot of each code): codes number the different ones."""
        size = 1 + n_a + n_b
        end = np.cumsum(size)
        name = np.empty(int(end[-1]), np.int32)
        name[end - size] = n_a
        name[ranges(end - size + 1, n_a)] = ids_a
        name[ranges(end - n_b, n_b)] = ids_b
        coded = runs_of(name.view(np.uint8), 4 * (end - size)).dictionary_encode()
        code = coded.indices.to_numpy().astype(np.int64)
        slot, fresh = self.memo.slots(strings_of(coded.dictionary))
        if fresh:
            first = np.empty(slot.size, np.int64)
            first[code[::-1]] = np.arange(code.size)[::-1]
            own = first[fresh]
            at_a, at_b = np.cumsum(n_a) - n_a, np.cumsum(n_b) - n_b
            self.align(
                ids_a[ranges(at_a[own], n_a[own])], ids_b[ranges(at_b[own], n_b[own])], n_a[own], n_b[own]
            )
        return code, slot


class Aligner:
    def __init__(self, path_a: str, path_b: str) -> None:
        self.a, self.b = byte_level_side(path_a), piece_side(path_b)
        self.windows = Windows(self.a, self.b)

    def forget(self) -> None:
        self.a.segments.forget()
        self.b.segments.forget()
        self.windows.forget()
        release_memory()

    def run(self, data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray | list]:
        """Numbers per text, windows per text, and the links of the different windows."""
        if self.windows.memo.full():
            self.windows.forget()
        n = offsets.size - 1
        length = np.diff(offsets)
        # Blank and text; a text without a byte stays without one.
        some = (length > 0).astype(np.int64)
        marked = np.concatenate([[0], np.cumsum(length + some)])
        spaced = np.full(int(marked[-1]), 32, np.uint8)
        spaced[ranges(marked[:-1] + some, length)] = data
        (ids_a, at_a), (ids_b, at_b) = self.a.encode(spaced, marked), self.b.encode(spaced, marked)
        good = (length > 0) & self.a.same_bytes(ids_a, at_a, spaced, marked) & self.b.same_bytes(ids_b, at_b, spaced, marked)
        n_a, n_b = np.diff(at_a) * good, np.diff(at_b) * good
        ids_a, ids_b = ids_a[ranges(at_a[:-1], n_a)], ids_b[ranges(at_b[:-1], n_b)]
        out = {"n_a": n_a, "n_b": n_b}
        zeros = np.zeros(0, np.int64)
        if not ids_a.size:
            nothing = np.zeros(n, np.int64)
            return out | {
                "n_groups": nothing, "n_links": nothing, "digest": [""] * n, "n_windows": nothing,
                "codes": zeros, "window_links": zeros, "links": zeros,
            }
        end_a, end_b = np.cumsum(self.a.length[ids_a]), np.cumsum(self.b.length[ids_b])
        place = np.searchsorted(end_b, end_a)
        shared = np.flatnonzero(end_b[place] == end_a)
        behind_a, behind_b = shared + 1, place[shared] + 1
        last = np.zeros(ids_a.size + 1, bool)
        last[np.cumsum(n_a)] = True
        next_a = np.minimum(behind_a, ids_a.size - 1)
        next_b = np.minimum(behind_b, ids_b.size - 1)
        anchor = last[behind_a] | (self.a.spaced[ids_a[next_a]] & self.b.spaced[ids_b[next_b]])
        to_a, to_b = behind_a[anchor], behind_b[anchor]
        size_a, size_b = np.diff(to_a, prepend=0), np.diff(to_b, prepend=0)
        text = np.searchsorted(np.cumsum(n_a), to_a, "left")
        code, slot = self.windows.find(ids_a, ids_b, size_a, size_b)
        links, window_links = self.windows.links.take(slot)
        groups = self.windows.groups.sizes[slot]
        per_text = lambda values: np.bincount(text, weights=values[code], minlength=n).astype(np.int64)
        n_windows = np.bincount(text, minlength=n)
        texts = [self.windows.texts[s] for s in slot.tolist()]
        digest, at = [], 0
        codes = code.tolist()
        for many in n_windows.tolist():
            digest.append(digest_of(texts, codes, at, at + many) if many else "")
            at += many
        return out | {
            "n_groups": per_text(groups), "n_links": per_text(window_links), "digest": digest, "n_windows": n_windows,
            "codes": code, "window_links": window_links, "links": links,
        }


def digest_of(texts: list[bytes], codes: list[int], first: int, last: int) -> str:
    found = hashlib.sha256()
    for at in range(first, last, HASHED_TOGETHER):
        if at > first:
            found.update(b";")
        found.update(b";".join([texts[c] for c in codes[at : min(last, at + HASHED_TOGETHER)]]))
    return found.hexdigest()


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def aligner(*paths: str) -> Aligner:
    if paths not in _ALIGNERS:
        _ALIGNERS[paths] = Aligner(*paths)
        release_memory()
    return _ALIGNERS[paths]


# --- the corpus -------------------------------------------------------------------

PER_TEXT = ["n_a", "n_b", "n_groups", "n_links", "digest", "n_windows"]
RUNS_SCHEMA = (
    "row array<long>, doc_id array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, "
    "n_links array<long>, digest array<string>, n_windows array<int>, codes array<int>, "
    "window_links array<int>, links array<{pair}>"
)


def pair_type(path_a: str, path_b: str) -> str:
    """The type that holds every pair code of two vocabularies."""
    n_a, n_b = (len(side(path).token_bytes) for side, path in ((byte_level_side, path_a), (piece_side, path_b)))
    return "int" if n_a * n_b < 1 << 31 else "long"


def aligned_runs(docs: DataFrame, path_a: str, path_b: str, run_bytes: int = RUN_BYTES) -> DataFrame:
    """A row per run of whole texts, see the module's docstring."""
    pair = pair_type(path_a, path_b)
    kinds = {"digest": pa.string(), "n_windows": pa.int32(), "codes": pa.int32(), "window_links": pa.int32()}
    kinds["links"] = pa.int32() if pair == "int" else pa.int64()

    def run(batches):
        work = aligner(path_a, path_b)
        try:
            for batch in batches:
                data, offsets = text_buffer(batch.column("text"))
                for first, last in pieces(offsets, run_bytes):
                    found = work.run(data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first])
                    part = batch.slice(first, last - first)
                    columns = {"row": part.column("row"), "doc_id": part.column("doc_id")}
                    columns |= {k: pa.array(v, kinds.get(k, pa.int64())) for k, v in found.items()}
                    yield pa.RecordBatch.from_arrays(
                        [pa.ListArray.from_arrays(pa.array([0, len(c)], pa.int32()), c) for c in columns.values()],
                        list(columns),
                    )
        finally:
            work.forget()

    numbered = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
    )
    return numbered.mapInArrow(run, RUNS_SCHEMA.format(pair=pair))


def values_of(row: pa.RecordBatch, i: int, name: str) -> np.ndarray:
    return row.column(name).slice(i, 1).flatten().to_numpy(zero_copy_only=False)


def pair_counts(runs: DataFrame) -> DataFrame:
    """(pair, count): over how many links of the corpus each pair of ids stands. A task sums
    up the pairs it has met before it passes them on."""

    def run(batches):
        pairs, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            for i in range(batch.num_rows):
                each = values_of(batch, i, "window_links")
                times = np.repeat(np.bincount(values_of(batch, i, "codes"), minlength=each.size), each)
                both = np.concatenate([pairs, values_of(batch, i, "links").astype(np.int64)])
                pairs, inverse = np.unique(both, return_inverse=True)
                counts = np.bincount(inverse, weights=np.concatenate([counts, times]), minlength=pairs.size).astype(np.int64)
                if pairs.size > 1 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(counts)], ["pair", "count"])
                    pairs, counts = pairs[:0], counts[:0]
        yield pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(counts)], ["pair", "count"])

    counted = runs.select("codes", "window_links", "links").mapInArrow(run, "pair long, count long")
    return counted.groupBy("pair").agg(F.sum("count").alias("count"))


def frequent_pairs(counts: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray]:
    """At most that many pairs, ascending, and their counts: those from some count on."""
    step = F.floor(F.log2("count") * F.lit(float(STEPS_PER_DOUBLING))).cast("int")
    total, lowest = 0, 1 << 30
    for r in sorted(counts.groupBy(step.alias("step")).count().collect(), reverse=True):
        total += r["count"]
        if total > most:
            break
        lowest = r["step"]
    rows = sorted((r["pair"], r["count"]) for r in counts.where(step >= lowest).collect())
    return np.array([p for p, _ in rows], np.int64), np.array([c for _, c in rows], np.int64)


def text_sums(runs: DataFrame, pairs: np.ndarray, counts: np.ndarray, best: np.ndarray) -> DataFrame:
    """A row per text: its numbers, the sums over its links of broadcast pairs, and the
    other pairs of its links."""
    shipped = runs.sparkSession.sparkContext.broadcast((pairs, counts, best))
    schema = (
        "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
        "best_known long, sum_known long, rest array<long>"
    )

    def run(batches):
        pairs, counts, best = shipped.value
        for batch in batches:
            for i in range(batch.num_rows):
                links, each = values_of(batch, i, "links").astype(np.int64), values_of(batch, i, "window_links")
                codes, n_windows = values_of(batch, i, "codes"), values_of(batch, i, "n_windows")
                window = np.repeat(np.arange(each.size), each)
                place = np.minimum(np.searchsorted(pairs, links), max(0, pairs.size - 1))
                hit = pairs[place] == links if pairs.size else np.zeros(links.size, bool)
                count = np.zeros(links.size, np.int64)
                count[hit] = counts[place[hit]]
                top = hit & (count == best[links % best.size])
                window_sum, window_best = np.zeros((2, each.size), np.int64)
                np.add.at(window_sum, window, count)
                np.add.at(window_best, window, top)
                ends = np.concatenate([[0], np.cumsum(n_windows)])
                per_text = lambda v: np.diff(np.concatenate([[0], np.cumsum(v[codes])])[ends])  # noqa: B023, E731
                missed = np.bincount(window[~hit], minlength=each.size)
                start = np.cumsum(missed) - missed
                rest = links[~hit][ranges(start[codes], missed[codes])]
                lists = pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], np.cumsum(per_text(missed))]), pa.int32()), pa.array(rest, pa.int64())
                )
                whole = [batch.column(c).slice(i, 1).flatten() for c in ("row", "doc_id", *PER_TEXT[:5])]
                yield pa.RecordBatch.from_arrays(
                    [*whole, pa.array(per_text(window_best)), pa.array(per_text(window_sum)), lists],
                    [c.split()[0] for c in schema.split(", ")],
                )

    return runs.mapInArrow(run, schema)


def align_tokenizers(
    spark: SparkSession, docs: DataFrame, path_a: str, path_b: str, broadcast_pairs: int = BROADCAST_PAIRS
) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 for every row.

    A is the byte-level tokenizer at path_a, B the piece model at path_b. Null and empty
    texts, and those whose tokens do not join to blank and text on both sides, have no
    tokens: zeros and ''. Repeated rows and null ids are texts of their own and count
    each; an empty table gives an empty one. Columns other than doc_id and text are ignored.
    """
    prepare(spark)
    # Rows hold a run each, and both sides of a batch lie in memory.
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    # Read row by row: the columnar reader would hold all runs of a file at once.
    spark.conf.set("spark.sql.parquet.enableNestedColumnVectorizedReader", "false")
    runs = materialize(spark, aligned_runs(docs, path_a, path_b), "alignment-runs")
    counts = materialize(spark, pair_counts(runs), "alignment-pairs")
    n_b = len(piece_side(path_b).token_bytes)
    best = np.zeros(n_b, np.int64)
    best_of = counts.groupBy((F.col("pair") % n_b).cast("int").alias("b")).agg(F.max("count").alias("best"))
    for r in best_of.collect():  # a row per id of B's vocabulary at most
        best[r.b] = r.best
    texts = materialize(spark, text_sums(runs, *frequent_pairs(counts, broadcast_pairs), best), "alignment-texts")
    scored = counts.withColumn("b", F.col("pair") % n_b).join(
        best_of.select(F.col("b").cast("long").alias("b"), "best"), "b"
    ).select("pair", "count", (F.col("count") == F.col("best")).cast("long").alias("top"))
    rest = (
        texts.select("row", F.explode("rest").alias("pair")).join(scored, "pair").groupBy("row")
        .agg(F.sum("top").alias("best_rest"), F.sum("count").alias("sum_rest"))
    )
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    return texts.join(rest, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", (F.col("best_known") + zero("best_rest")).alias("n_best"),
        (F.col("sum_known") + zero("sum_rest")).alias("count_sum"), "groups_sha256",
    )
