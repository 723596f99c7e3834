"""Language-model scores of whole texts: a hidden Markov model, and a unigram base.

Tokens are words and one end per text. A word that is common has a class of its own; the
others share classes by their last two bytes and are drawn inside their class by their
corpus counts, so the model is a distribution over all texts. Latent states emit classes.
Baum-Welch counts of all training texts are summed up per task and then over partitions;
the scaled forward recursion gives the likelihood of a text.

Only tables of a fixed number of rows are broadcast: the words of the highest counts. The
counts of all other words reach their tokens by a join on the word, where none is hot.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidegate.llm.common import lower_words, pieces, prepare, text_buffer
from tidegate.session import materialize

#: Latent states and rounds of Baum-Welch.
STATES = 8
ROUNDS = 4
#: Words with a class of their own, and words whose counts are broadcast, at most.
OWN_CLASSES = 8_192
BROADCAST_WORDS = 131_072
#: Classes that the other words share.
SHARED_CLASSES = 256
#: Longest word that stands for itself in the tables; a longer one goes by a digest.
NAME_BYTES = 32
#: Tokens that one round of array operations holds, and steps in which a text is walked
#: through; a longer text is cut, and matrices over its cuts carry the states across.
WALK_TOKENS = 400_000
WALK_STEPS = 4_096
#: Bytes of text counted together.
COUNTED_BYTES = 8 << 20
#: Steps after which weights are scaled again; the product of that many emissions is far
#: above the least number.
SCALED = 8
#: Added to expected counts: to a transition, and to an emission in shares of the unigram.
TRANSITION_PRIOR = 1.0
EMISSION_PRIOR = 20.0
#: Histogram steps per doubling of a count.
STEPS_PER_DOUBLING = 16


# --- words ------------------------------------------------------------------------


def names_of(words: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(names, shared classes) of different words. A name is the word, or for a long one
    (or one that begins like a digest) a zero byte and 128 bits of its digest."""
    lengths = pc.binary_length(words).to_numpy(zero_copy_only=False)
    places = np.frombuffer(words.buffers()[1], np.int64, len(words) + 1, words.offset * 8)
    letters = np.frombuffer(words.buffers()[2], np.uint8)
    ends = places[1:]
    last = letters[ends - 1].astype(np.int64) if len(words) else np.zeros(0, np.int64)
    before = np.where(lengths > 1, letters[np.maximum(ends - 2, 0)], 0).astype(np.int64) if len(words) else last
    shape = (last * 131 + before) % SHARED_CLASSES
    odd = np.flatnonzero((lengths > NAME_BYTES) | (letters[places[:-1]] == 0)) if len(words) else last
    if odd.size:
        every = words.to_pylist()
        for i in odd.tolist():
            every[i] = b"\0" + hashlib.blake2b(every[i], digest_size=16).digest()
        words = pa.array(every, pa.large_binary())
    return words, shape


def is_held_out():
    """Texts that nothing is learned from; a null id is learned from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 1, F.lit(False))


def count_words(texts: DataFrame) -> DataFrame:
    """(word, shape, c): how often each word stands in the texts; the empty word is the end."""

    def run(batches):
        for batch in batches:
            data, offsets = text_buffer(batch.column("text"))
            for first, last in pieces(offsets, COUNTED_BYTES):
                words, _ = lower_words(data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first])
                coded = words.dictionary_encode()
                counts = np.bincount(coded.indices.to_numpy(), minlength=len(coded.dictionary))
                names, shape = names_of(coded.dictionary)
                yield pa.RecordBatch.from_arrays(
                    [names.cast(pa.binary()), pa.array(shape, pa.int32()), pa.array(counts, pa.int64())],
                    ["word", "shape", "c"],
                )
            yield pa.RecordBatch.from_arrays(
                [pa.array([b""], pa.binary()), pa.array([0], pa.int32()), pa.array([batch.num_rows], pa.int64())],
                ["word", "shape", "c"],
            )

    counted = texts.select("text").mapInArrow(run, "word binary, shape int, c long")
    return counted.groupBy("word", "shape").agg(F.sum("c").alias("c")).where("c > 0")


@dataclass
class Vocabulary:
    """What tasks know of the corpus: totals, the words of the highest counts in order of
    their bytes with counts and classes, and the totals of the shared classes."""

    tokens: int
    different: int
    words: list[bytes]
    counts: np.ndarray
    classes: np.ndarray
    own: int
    end_count: int
    class_counts: np.ndarray
    class_words: np.ndarray

    @property
    def end_class(self) -> int:
        return self.own + SHARED_CLASSES

    def base_log(self, counts):
        return np.log10((np.asarray(counts, float) + 0.5) / (self.tokens + 0.5 * (self.different + 1)))

    def unigram(self) -> np.ndarray:
        """Share of each class among the training tokens, smoothed."""
        weights = np.full(self.end_class + 1, 0.5)
        own = self.classes < self.own
        weights[self.classes[own]] += self.counts[own]
        weights[self.own : self.end_class] += self.class_counts
        weights[self.end_class] += self.end_count
        return weights / weights.sum()


def step_of(column):
    return F.floor(F.log2(column) * F.lit(float(STEPS_PER_DOUBLING))).cast("int")


def lowest_step(histogram: list[tuple[int, int]], most: int) -> int:
    """The lowest step from which on at most that many words stand."""
    total, lowest = 0, 1 << 30
    for step, n in sorted(histogram, reverse=True):
        total += n
        if total > most:
            break
        lowest = step
    return lowest


def read_vocabulary(table: DataFrame) -> Vocabulary:
    """The vocabulary of a table (word, shape, c). What comes to the driver has at most
    BROADCAST_WORDS rows of NAME_BYTES and two numbers, beside a histogram and the classes."""
    words = table.where(F.octet_length("word") > 0)
    ends = table.where(F.octet_length("word") == 0).agg(F.sum("c")).first()[0] or 0
    histogram = [
        (r.step, r.n, r.c)
        for r in words.groupBy(step_of("c").alias("step")).agg(F.count("*").alias("n"), F.sum("c").alias("c")).collect()
    ]
    known = lowest_step([(s, n) for s, n, _ in histogram], BROADCAST_WORDS)
    common = lowest_step([(s, n) for s, n, _ in histogram], OWN_CLASSES)
    top = sorted(
        (bytes(r.word), r.c, r.shape, r.own)
        for r in words.where(step_of("c") >= known)
        .select("word", "c", "shape", (step_of("c") >= common).alias("own")).collect()
    )
    shared = words.where(step_of("c") < common).groupBy("shape").agg(F.sum("c").alias("c"), F.count("*").alias("n")).collect()
    own = sum(r[3] for r in top)
    class_counts, class_words = np.zeros(SHARED_CLASSES), np.zeros(SHARED_CLASSES)
    for r in shared:
        class_counts[r["shape"]], class_words[r["shape"]] = r["c"], r["n"]
    rank, classes = 0, np.zeros(len(top), np.int32)
    for i, (_, _, shape, is_own) in enumerate(top):
        classes[i] = rank if is_own else own + shape
        rank += is_own
    return Vocabulary(
        tokens=int(sum(c for _, _, c in histogram) + ends), different=int(sum(n for _, n, _ in histogram) + (ends > 0)),
        words=[r[0] for r in top], counts=np.array([r[1] for r in top], np.int64), classes=classes, own=own,
        end_count=int(ends), class_counts=class_counts, class_words=class_words,
    )


def inside_log(vocabulary: Vocabulary, counts: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """log10 of a word's share of its class: 0 for words with one of their own."""
    shape = np.clip(classes - vocabulary.own, 0, SHARED_CLASSES - 1)
    n, v = vocabulary.class_counts[shape], vocabulary.class_words[shape]
    return np.where(classes < vocabulary.own, 0.0, np.log10((counts + 0.5) / (n + 0.5 * (v + 1))))


def class_sequences(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """A row per text: row (a number of its own), doc_id, held_out, n_tokens, n_known,
    base_known and inside_known (sums over the words in the broadcast), classes in order,
    and rest, its other words."""
    context = docs.sparkSession.sparkContext
    shipped = context.broadcast((vocabulary, np.array(vocabulary.words, object)))
    schema = (
        "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base_known double, "
        "inside_known double, classes array<int>, rest array<binary>, rest_shape array<int>"
    )

    def run(batches):
        vocabulary, words = shipped.value
        known = pa.array(words.tolist(), pa.large_binary())
        end_known = vocabulary.end_count > 0
        end_base = float(vocabulary.base_log(vocabulary.end_count))
        base = vocabulary.base_log(vocabulary.counts)
        inside = inside_log(vocabulary, vocabulary.counts, vocabulary.classes)
        for batch in batches:
            data, offsets = text_buffer(batch.column("text"))
            for first, last in pieces(offsets, COUNTED_BYTES):
                found, row = lower_words(data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first])
                coded = found.dictionary_encode()
                names, shape = names_of(coded.dictionary)
                slot = pc.fill_null(pc.index_in(names, value_set=known), -1).to_numpy(zero_copy_only=False)
                hit = slot >= 0
                kind = vocabulary.own + shape
                kind[hit] = vocabulary.classes[slot[hit]]
                per_base, per_inside = np.zeros(slot.size), np.zeros(slot.size)
                per_base[hit], per_inside[hit] = base[slot[hit]], inside[slot[hit]]
                code = coded.indices.to_numpy()
                n = last - first
                each = np.bincount(row, minlength=n)
                sums = [
                    np.bincount(row, weights=values[code], minlength=n) for values in (hit.astype(float), per_base, per_inside)
                ]
                # Every text ends with the end's class.
                ends = np.cumsum(each + 1)
                classes = np.full(int(ends[-1]) if n else 0, vocabulary.end_class, np.int32)
                places = np.ones(classes.size, bool)
                places[ends - 1] = False
                classes[places] = kind[code]
                rare = np.flatnonzero(~hit[code])
                rest_at = np.concatenate([[0], np.cumsum(np.bincount(row[rare], minlength=n))])
                lists = lambda at, values: pa.ListArray.from_arrays(pa.array(at, pa.int32()), values)
                part = batch.slice(first, n)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("row"), part.column("doc_id"), part.column("held_out"),
                        pa.array(each + 1, pa.int64()), pa.array(sums[0].astype(np.int64) + end_known, pa.int64()),
                        pa.array(sums[1] + end_base), pa.array(sums[2]),
                        lists(np.concatenate([[0], ends]), pa.array(classes)),
                        lists(rest_at, names.take(pa.array(code[rare])).cast(pa.binary())),
                        lists(rest_at, pa.array(shape[code[rare]], pa.int32())),
                    ],
                    [c.split()[0] for c in schema.split(", ")],
                )

    numbered = docs.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", is_held_out().alias("held_out"), "text"
    )
    return numbered.mapInArrow(run, schema)


def rest_sums(sequences: DataFrame, table: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """(row, rest_known, rest_base, rest_inside): what the words outside the broadcast add.
    None of these is among the most frequent ones, so no key of the join is hot."""
    tokens = sequences.select("row", F.explode(F.arrays_zip("rest", "rest_shape")).alias("t")).select(
        "row", F.col("t.rest").alias("word"), F.col("t.rest_shape").alias("shape")
    )
    joined = tokens.join(table.select("word", "c"), "word", "left")
    c = F.coalesce(F.col("c"), F.lit(0)).cast("double")
    class_counts = F.array(*[F.lit(float(x)) for x in vocabulary.class_counts])
    class_words = F.array(*[F.lit(float(x)) for x in vocabulary.class_words])
    size = F.element_at(class_counts, F.col("shape") + 1) + 0.5 * (F.element_at(class_words, F.col("shape") + 1) + 1)
    whole = F.lit(float(vocabulary.tokens + 0.5 * (vocabulary.different + 1)))
    return joined.groupBy("row").agg(
        F.count("c").alias("rest_known"),
        F.sum(F.log10((c + 0.5) / whole)).alias("rest_base"),
        F.sum(F.log10((c + 0.5) / size)).alias("rest_inside"),
    )


# --- the model --------------------------------------------------------------------


@dataclass
class HiddenMarkov:
    """start (K), move (K x K, rows sum to 1), emit (classes x K, columns sum to 1)."""

    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray


def first_model(unigram: np.ndarray, states: int, seed: int = 7) -> HiddenMarkov:
    """States that lean to themselves, with emissions shaken around the unigram."""
    draw = np.random.default_rng(seed)
    emit = unigram[:, None] * draw.uniform(0.5, 1.5, (unigram.size, states))
    move = np.full((states, states), 0.2 / states) + 0.8 * np.eye(states)
    return HiddenMarkov(np.full(states, 1 / states), move, emit / emit.sum(axis=0))


def steps_of(at: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(token places step after step, where each step begins) of runs, longest first."""
    steps = int(n[0]) if n.size else 0
    live = np.searchsorted(-n, -np.arange(steps), "left")
    where = np.concatenate([[0], np.cumsum(live)])
    run = np.arange(int(where[-1])) - np.repeat(where[:-1], live)
    return at[run] + np.repeat(np.arange(steps), live), where


def walk(model: HiddenMarkov, seen: np.ndarray, where: np.ndarray, before: np.ndarray, keep: bool = False):
    """Scaled forward recursion over runs of tokens, longest first, side by side.

    seen has the emissions of the runs' tokens, step after step, and before the state
    distribution ahead of each run's first token. Returns the distribution ahead of the
    token after each run, the log likelihood of each run, and with keep the forward
    weights of all tokens, each right up to a factor.
    """
    ahead, total = before.copy(), np.zeros(before.shape[0])
    held = np.empty_like(seen) if keep else np.empty_like(before)
    for t in range(where.size - 1):
        first, last = where[t], where[t + 1]
        m = last - first
        now = held[first:last] if keep else held[:m]
        np.multiply(ahead[:m], seen[first:last], out=now)
        if t % SCALED == SCALED - 1:
            scale = now.sum(axis=1, keepdims=True)
            now /= scale
            total[:m] += np.log(scale[:, 0])
        np.matmul(now, model.move, out=ahead[:m])
    scale = ahead.sum(axis=1, keepdims=True)
    return ahead / scale, total + np.log(scale[:, 0]), held


@dataclass
class Runs:
    """Runs of at most WALK_STEPS tokens, each text's in order: first token, length, text,
    whether it begins and ends its text, and the model's view of what lies around it."""

    at: np.ndarray
    n: np.ndarray
    text: np.ndarray
    begins: np.ndarray
    ends: np.ndarray
    before: np.ndarray
    behind: np.ndarray


def cut_runs(model: HiddenMarkov, ids: np.ndarray, offsets: np.ndarray, steps: int) -> Runs:
    """Runs with the state distribution before and the weight of all that follows behind.

    A text of one run needs no look around. Of a longer one every run is walked from each
    state; the rows so found are the run's transfer matrix, and products of matrices from
    the left and from the right give both sides.
    """
    states = model.start.size
    length = np.diff(offsets)
    parts = np.maximum(1, -(-length // steps))
    text = np.repeat(np.arange(length.size), parts)
    part = np.arange(text.size) - np.repeat(np.cumsum(parts) - parts, parts)
    at = offsets[:-1][text] + part * steps
    n = np.minimum(steps, offsets[1:][text] - at)
    begins, ends = part == 0, part == parts[text] - 1
    before = np.tile(model.start, (text.size, 1))
    behind = np.ones((text.size, states))
    cut = np.flatnonzero(parts[text] > 1)
    if cut.size:
        log = np.empty((cut.size, states))
        to = np.empty((cut.size, states, states))
        each = max(1, WALK_TOKENS // (steps * states))
        for first in range(0, cut.size, each):
            own = cut[first : first + each]
            order = np.argsort(-n[own], kind="stable")
            rows = np.repeat(own[order], states)
            places, where = steps_of(at[rows], n[rows])
            after, total, _ = walk(model, model.emit[ids[places]], where, np.tile(np.eye(states), (own.size, 1)))
            to[first + order] = after.reshape(-1, states, states)
            log[first + order] = total.reshape(-1, states)
        weight = np.exp(log - log.max(axis=1, keepdims=True))
        for i in range(cut.size - 1):
            if not ends[cut[i]]:
                ahead = (before[cut[i]] * weight[i]) @ to[i]
                before[cut[i + 1]] = ahead / ahead.sum()
        for i in range(cut.size - 1, 0, -1):
            if not begins[cut[i]]:
                value = weight[i] * (to[i] @ behind[cut[i]])
                behind[cut[i - 1]] = value / value.max()
    return Runs(at, n, text, begins, ends, before, behind)


def grouped(n: np.ndarray, most: int) -> Iterator[np.ndarray]:
    """Runs of like length by groups of about that many tokens, the longest first."""
    order = np.argsort(-n, kind="stable")
    group = np.cumsum(n[order]) // most
    yield from np.split(order, np.flatnonzero(np.diff(group)) + 1)


def likelihoods(model: HiddenMarkov, ids: np.ndarray, offsets: np.ndarray, steps: int = WALK_STEPS) -> np.ndarray:
    """The natural log likelihood of every sequence."""
    runs = cut_runs(model, ids, offsets, steps)
    out = np.zeros(offsets.size - 1)
    for own in grouped(runs.n, WALK_TOKENS):
        places, where = steps_of(runs.at[own], runs.n[own])
        _, total, _ = walk(model, model.emit[ids[places]], where, runs.before[own])
        np.add.at(out, runs.text[own], total)
    return out


class ExpectedCounts:
    """Sums of Baum-Welch's expected counts over the sequences given to add."""

    def __init__(self, model: HiddenMarkov) -> None:
        self.model = model
        self.start = np.zeros_like(model.start)
        self.move = np.zeros_like(model.move)
        self.emit = np.zeros_like(model.emit)

    def add(self, ids: np.ndarray, offsets: np.ndarray, steps: int = WALK_STEPS) -> None:
        model = self.model
        runs = cut_runs(model, ids, offsets, steps)
        for own in grouped(runs.n, WALK_TOKENS):
            places, where = steps_of(runs.at[own], runs.n[own])
            token = ids[places]
            seen = model.emit[token]
            _, _, ahead = walk(model, seen, where, runs.before[own], keep=True)
            # Weight of all that follows a token, per state of the next one.
            behind = np.empty_like(seen)
            back = runs.behind[own].copy()
            turned = np.ascontiguousarray(model.move.T)
            value = np.empty_like(back)
            for t in range(where.size - 2, -1, -1):
                first, last = where[t], where[t + 1]
                m = last - first
                behind[first:last] = back[:m]
                np.matmul(back[:m], turned, out=value[:m])
                np.multiply(value[:m], seen[first:last], out=back[:m])
                if t % SCALED == 0:
                    back[:m] /= back[:m].max(axis=1, keepdims=True)
            state = ahead * (behind @ turned)
            scale = 1 / state.sum(axis=1, keepdims=True)
            state *= scale
            # A text's last token moves nowhere.
            ahead *= scale
            last_of = runs.ends[own]
            final = where[runs.n[own] - 1] + np.arange(own.size)
            ahead[final[last_of]] = 0
            self.move += (ahead.T @ behind) * model.move
            self.start += state[: where[1]][runs.begins[own]].sum(axis=0)
            for k in range(model.start.size):
                self.emit[:, k] += np.bincount(token, weights=state[:, k], minlength=self.emit.shape[0])


def sequence_runs(batches, column: str = "classes") -> Iterator[tuple[np.ndarray, np.ndarray, pa.RecordBatch]]:
    """(ids, offsets, rows) for bounded runs of whole sequences."""
    for batch in batches:
        lists = batch.column(column)
        offsets = lists.offsets.to_numpy().astype(np.int64)
        ids = lists.values.to_numpy(zero_copy_only=False)
        for first, last in pieces(offsets, 8 * WALK_TOKENS):
            yield ids, offsets[first : last + 1], batch.slice(first, last - first)


def expected_counts(sequences: DataFrame, model: HiddenMarkov) -> DataFrame:
    """(kind, counts): expected counts of all sequences, one row for each class, for each
    state's moves (-2 - state) and for the starts (-1). Tasks pass on one row per kind."""
    shipped = sequences.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        found = ExpectedCounts(shipped.value)
        for ids, offsets, _ in sequence_runs(batches):
            found.add(ids, offsets)
        used = np.flatnonzero(found.emit.any(axis=1))
        states = found.start.size
        kinds = np.concatenate([[-1], -2 - np.arange(states), used])
        counts = np.concatenate([found.start[None], found.move, found.emit[used]])
        yield pa.RecordBatch.from_arrays(
            [pa.array(kinds, pa.int32()), *(pa.array(counts[:, k]) for k in range(states))],
            ["kind", *(f"s{k}" for k in range(states))],
        )

    states = model.start.size
    columns = [f"s{k}" for k in range(states)]
    rows = sequences.select("classes").mapInArrow(run, "kind int, " + ", ".join(f"{c} double" for c in columns))
    return rows.groupBy("kind").agg(*(F.sum(c).alias(c) for c in columns))


def next_model(counts: list, unigram: np.ndarray, model: HiddenMarkov) -> HiddenMarkov:
    """The model of the summed counts, drawn a little towards evenness and the unigram."""
    states = model.start.size
    start, move = np.full(states, TRANSITION_PRIOR), np.full((states, states), TRANSITION_PRIOR)
    emit = np.tile(EMISSION_PRIOR * unigram[:, None], states)
    for kind, *values in counts:
        if kind == -1:
            start += values
        elif kind < -1:
            move[-2 - kind] += values
        else:
            emit[kind] += values
    return HiddenMarkov(start / start.sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))


def train(sequences: DataFrame, unigram: np.ndarray, states: int = STATES, rounds: int = ROUNDS) -> HiddenMarkov:
    """Baum-Welch over all sequences: a pass per round. The driver gets one row of states
    numbers per class, which OWN_CLASSES and SHARED_CLASSES bound."""
    model = first_model(unigram, states)
    for _ in range(rounds):
        model = next_model(expected_counts(sequences, model).collect(), unigram, model)
    return model


def score_sequences(sequences: DataFrame, model: HiddenMarkov) -> DataFrame:
    """(row, ln): the log likelihood of every class sequence, to the base of 10."""
    shipped = sequences.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for ids, offsets, rows in sequence_runs(batches):
            logs = likelihoods(shipped.value, ids, offsets) / np.log(10)
            out = [*(rows.column(c) for c in PASSED), pa.array(logs)]
            yield pa.RecordBatch.from_arrays(out, [*PASSED, "model_log"])

    types = "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base_known double, inside_known double"
    return sequences.select(*PASSED, "classes").mapInArrow(run, types + ", model_log double")


PASSED = ["row", "doc_id", "held_out", "n_tokens", "n_known", "base_known", "inside_known"]


def language_model_scores(
    spark: SparkSession, docs: DataFrame, states: int = STATES, rounds: int = ROUNDS
) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row.

    score is the hidden Markov model's log10 probability of the whole text with its end,
    base_score the smoothed unigram's. A null or empty text is its end alone. Rows with a
    null id are learned from; repeated rows count each time and are scored each. Of an
    empty table, or where nothing is learned from, every known count is 0. Columns other
    than doc_id and text are ignored. The order of sums is Spark's: scores agree between
    runs but for rounding.
    """
    prepare(spark)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    table = materialize(spark, count_words(texts.where(~is_held_out())), "lm-words")
    vocabulary = read_vocabulary(table)
    sequences = materialize(spark, class_sequences(texts, vocabulary), "lm-sequences")
    model = train(sequences.where("not held_out"), vocabulary.unigram(), states, rounds)
    scored = score_sequences(sequences, model)
    rest = rest_sums(sequences, table, vocabulary)
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    return scored.join(rest, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + zero("rest_known")).alias("n_known"),
        F.lit(vocabulary.tokens).cast("long").alias("train_tokens"),
        (F.col("base_known") + zero("rest_base")).alias("base_score"),
        (F.col("model_log") + F.col("inside_known") + zero("rest_inside")).alias("score"),
    )

