"""Benchmark decontamination by latent semantic retrieval and exact checks.

1. Texts and items are series of passages: windows of WINDOW words, each half a
   window on. Words are hashed to DIMENSIONS. Weights are TF-IDF: document
   frequencies are counted over all texts; a weight is at least FLOOR, so a passage
   that very many texts share stays visible, and at most CEILING; words that many
   items of different words have (stop words) weigh nothing.
2. The benchmark is taken in blocks of at most BLOCK_PASSAGES passages; as many blocks as
   PASS_BYTES of tables hold go to the texts in one pass over them. A
   randomised SVD finds the latent directions of a block's TF-IDF passages; tasks
   multiply their passages with a thin matrix and sum up what they get. The rank is
   the smallest that leaves every passage KEEP of its length, so each item can be
   found, whatever the benchmark.
3. All passages of all texts are projected; those whose cosine with an item's
   passage is at least CANDIDATE are candidates. (The length of a text's passage is
   that of its whole TF-IDF vector, so what lies outside the latent space counts
   against it. A projection shorter than CANDIDATE of it can't reach the cosine.)
   An item of stop words and light words (templated questions) may stay below that
   cosine among other words even if it's copied word for word. Where the estimate
   in ``weak`` says so, each place that holds RUN of the item's words in a row is a
   candidate too (its cosine is null where only the run was found).
4. A candidate's surroundings in the text are compared with the item: if enough of
   the item's words are there at all (a bound that loses nothing), the longest
   common subsequence of words decides. From COPY of the item's words on it's a copy; from
   PARAPHRASE on it counts if the answer (the item's ``answer`` column, else its last
   sentence) is there too, to ANSWER of its words in order.

5. Items of fewer than LEAST_WORDS words are found exactly: all their words in a row, and the
   answer near, if the item has one of its own. Fewer than LEAST_EXACT words without an
   answer of their own stand in any text by chance: such items (and null and empty ones)
   aren't searched.

Texts are never shuffled.

Words are runs of ASCII letters and digits and of non-ASCII characters,
lower-cased. Null and empty texts hold nothing.
Repeated rows and repeated items are reported each. Of several places in a text the
best counts, the first of equals. An empty table on either side gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitewatts.llm.common import columns, field, hashed_words, mix, read, slices, stored

WINDOW = 32
HALF = WINDOW // 2
DIMENSIONS = 1 << 18
#: Bounds of a word's weight; their ratio, and so the cosines of copies, don't change with the number of texts.
FLOOR, CEILING = 3.0, 8.0
#: A word is a stop word if more than this share of the items has it, and more than STOP_ITEMS.
STOP_SHARE, STOP_ITEMS = 0.02, 3
BLOCK_PASSAGES = 512
KEEP, POWERS, SEED = 0.7, 2, 7
CANDIDATE = 0.25
COPY, PARAPHRASE, ANSWER = 0.85, 0.6, 0.8
LEAST_WORDS, LEAST_EXACT = 8, 4
#: Bytes of the blocks' tables that one pass over the texts takes along.
PASS_BYTES = 64 << 20
#: Words in a row that make a place a candidate for an item that its weights may not find.
RUN = 3
#: Rows of the thin matrix that are shuffled together, and windows that are searched together.
CHUNK, ROUND = 512, 4096


def dims(word: np.ndarray) -> np.ndarray:
    return (word & np.uint64(DIMENSIONS - 1)).astype(np.int64)


class Passages:
    """The half windows and windows of some texts' words."""

    def __init__(self, row: np.ndarray, word: np.ndarray, rows: int):
        counts = np.bincount(row, minlength=rows)
        self.first_word = np.cumsum(counts) - counts
        place = np.arange(len(row)) - self.first_word[row]
        begins = np.flatnonzero(place % HALF == 0)
        self.half_start = begins
        self.half_row = row[begins]
        self.half_of_word = np.cumsum(place % HALF == 0) - 1
        follows = np.append(self.half_row[1:] == self.half_row[:-1], False) if len(begins) else np.zeros(0, bool)
        last = np.append(self.half_row[1:] != self.half_row[:-1], True) if len(begins) else np.zeros(0, bool)
        alone = last & np.append(True, self.half_row[1:] != self.half_row[:-1])[: len(begins)]
        #: A window is a half and the next; a text of one half is one window.
        self.window = np.flatnonzero(follows | alone)
        self.joined = follows[self.window]
        self.words, self.counts = word, counts

    def _windows(self, halves: np.ndarray) -> np.ndarray:
        out = halves[self.window]
        out[self.joined] += halves[self.window[self.joined] + 1]
        return out

    def lengths(self, weight: np.ndarray) -> np.ndarray:
        """The length of each window's vector (repeated words count one by one)."""
        if not len(self.half_start):
            return np.zeros(0, np.float32)
        return np.sqrt(self._windows(np.add.reduceat(weight[dims(self.words)] ** 2, self.half_start)))

    def projected(self, column: np.ndarray, table: np.ndarray) -> np.ndarray:
        """Per window the sum of its words' rows of ``table``; ``column`` is the row of each dimension, or -1."""
        halves = np.zeros((len(self.half_start), table.shape[1]), np.float32)
        at = column[dims(self.words)]
        kept = np.flatnonzero(at >= 0)
        if len(kept):
            owner = self.half_of_word[kept]
            first = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            place = np.arange(len(kept)) - np.repeat(first, np.diff(np.append(first, len(kept))))
            # the first kept words of all halves, then the second ones, ...: each half once a round
            order = np.argsort(place, kind="stable")
            ends = np.cumsum(np.bincount(place))
            for a, b in zip(ends - np.bincount(place), ends, strict=True):
                now = order[a:b]
                halves[owner[now]] += table[at[kept[now]]]
        return self._windows(halves)


def document_frequency(docs: DataFrame) -> tuple[np.ndarray, int]:
    """(texts that hold a word of each dimension, all texts); DIMENSIONS rows reach the driver at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(DIMENSIONS, np.int64), 0
        for batch in slices(batches):
            row, word = hashed_words(batch.column("text"))
            n += batch.num_rows
            total += np.bincount(np.unique(row * DIMENSIONS + dims(word)) % DIMENSIONS, minlength=DIMENSIONS)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict(
            {"dim": pa.array(np.append(used, -1), pa.int32()), "n": pa.array(np.append(total[used], n), pa.int64())}
        )

    found = docs.select("text").mapInArrow(run, "dim int, n long").groupBy("dim").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(DIMENSIONS + 1, np.int64)
    out[found["dim"].to_numpy()] = found["n"].to_numpy()
    return out[:-1], int(out[-1])


def _multiplied(passages: DataFrame, thin: np.ndarray) -> np.ndarray:
    """X^T X thin for the rows X of ``passages`` (columns, values), summed up over the tasks."""
    height, width = thin.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((height, width))
        for batch in batches:
            for columns_, values in zip(batch.column("columns"), batch.column("values"), strict=True):
                at, x = columns_.values.to_numpy(), values.values.to_numpy()
                total[at] += x[:, None] * (x @ thin[at])
        yield pa.RecordBatch.from_pydict(
            {
                "chunk": pa.array(range(-(-height // CHUNK)), pa.int32()),
                "part": pa.array([total[k : k + CHUNK].tobytes() for k in range(0, height, CHUNK)], pa.binary()),
            }
        )

    def summed(group: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(p) for p in group["part"])
        return pd.DataFrame({"chunk": group["chunk"][:1], "part": [total.tobytes()]})

    chunks = passages.mapInArrow(run, "chunk int, part binary").groupBy("chunk").applyInPandas(summed, "chunk int, part binary")
    out = np.zeros((height, width))
    # a block's vocabulary times its rank: both bounded by BLOCK_PASSAGES. As Arrow, whose bytes are neither pickled nor copied
    for batch in chunks.toArrow().to_batches():
        for chunk, part in zip(batch.column("chunk").to_pylist(), batch.column("part"), strict=True):
            out[chunk * CHUNK : (chunk + 1) * CHUNK] = np.frombuffer(part.as_buffer()).reshape(-1, width)
    return out


def basis(spark: SparkSession, matrix: list[tuple[np.ndarray, np.ndarray]], height: int) -> np.ndarray:
    """height x rank: right singular vectors of sparse rows (columns, values), by randomised subspace iteration."""
    ends = np.append(0, np.cumsum([len(at) for at, _ in matrix])).astype(np.int32)
    rows = pa.table(
        {
            "columns": pa.ListArray.from_arrays(ends, pa.array(np.concatenate([at for at, _ in matrix]), pa.int32())),
            "values": pa.ListArray.from_arrays(ends, pa.array(np.concatenate([x for _, x in matrix]), pa.float64())),
        }
    )
    passages = stored(spark.createDataFrame(rows, "columns array<int>, values array<double>"), "passages")
    thin = np.random.default_rng(SEED).standard_normal((height, min(height, len(matrix))))
    for _ in range(POWERS):
        thin = np.linalg.qr(_multiplied(passages, thin))[0]
    small = thin.T @ _multiplied(passages, thin)
    values, vectors = np.linalg.eigh((small + small.T) / 2)
    directions = thin @ vectors[:, np.argsort(-values)]
    # the smallest rank that leaves each row KEEP of its length
    rank = 1
    for at, x in matrix:
        energy = np.cumsum((x @ directions[at]) ** 2)
        rank = max(rank, int(np.searchsorted(energy, KEEP**2 * (x @ x))) + 1)
    return directions[:, : min(rank, directions.shape[1])]


def common_subsequence(a: list[int], b: list[int]) -> int:
    """Length of the longest common subsequence, bit-parallel over ``a``."""
    where: dict[int, int] = {}
    for k, x in enumerate(a):
        where[x] = where.get(x, 0) | 1 << k
    full = (1 << len(a)) - 1
    row = full
    for x in b:
        match = where.get(x)
        if match:
            both = row & match
            row = (row + both | row - both) & full
    return len(a) - row.bit_count()


def weak(weights: np.ndarray) -> bool:
    """Whether a copy of a passage, given its words' weights, may miss CANDIDATE among other words of weight CEILING.

    The copy begins at any place of a half window; of the two windows that share it the better one counts.
    """
    energy = np.append(0.0, np.cumsum(weights.astype(np.float64) ** 2))
    n, total = len(weights), energy[-1]
    if not total:
        return True
    before = np.arange(HALF)
    first, second = np.minimum(n, WINDOW - before), np.minimum(n, HALF - before)
    reach = []
    for held, words in ((energy[first], first), (total - energy[second], n - second)):
        size = np.sqrt(held + (WINDOW - words) * CEILING**2)
        reach.append(KEEP * held / np.sqrt(total) / np.maximum(size, 1e-12))
    return bool(np.maximum(*reach).min() < CANDIDATE)


def runs(word: np.ndarray, n: int = RUN) -> np.ndarray:
    """The hash of the ``n`` words that begin at each place but the last ones."""
    out = np.zeros(max(0, len(word) - n + 1), np.uint64)
    for j in range(n):
        out = mix(out * np.uint64(31) + word[j : j + len(out)])
    return out


class Items:
    """A block of benchmark items: words, answers, passages, and the latent space of the passages."""

    def __init__(self, rows: list[tuple], weight: np.ndarray):
        self.ids = [i for i, _, _ in rows]
        self.words = _by_row(*hashed_words(pa.array([t for _, t, _ in rows], pa.string())), len(rows))
        self.answers = _by_row(*hashed_words(pa.array([a for _, _, a in rows], pa.string())), len(rows))
        self.told = [(w.tolist(), Counter(w.tolist()), a.tolist()) for w, a in zip(self.words, self.answers, strict=True)]
        self.owner: list[int] = []
        passages: list[np.ndarray] = []
        for k, words in enumerate(self.words):
            for s in item_windows(len(words)):
                self.owner.append(k)
                passages.append(dims(words[s : s + WINDOW]))
        every = np.unique(np.concatenate(passages)) if passages else np.zeros(0, np.int64)
        self.used = every[weight[every] > 0]
        #: Row of each dimension in the tables, or -1.
        self.column = np.full(DIMENSIONS, -1, np.int32)
        self.column[self.used] = np.arange(len(self.used))
        self.matrix = []
        for p in passages:
            at, count = np.unique(self.column[p[weight[p] > 0]], return_counts=True)
            self.matrix.append((at, count * weight[self.used[at]].astype(np.float64)))
        self.table = self.vectors = np.zeros((0, 0), np.float32)
        strong = {k for k, p in zip(self.owner, passages, strict=True) if not weak(weight[p])}
        self.weak = sorted(set(self.owner) - strong)
        pairs = {(int(h), k) for k in self.weak for h in runs(self.words[k])}
        #: Runs of the weak items, sorted, with the item of each; a bit for each value of a run's low bits.
        self.runs = np.array([h for h, _ in sorted(pairs)], np.uint64)
        self.run_owner = np.array([k for _, k in sorted(pairs)], np.int64)
        self.run_bits = np.zeros(DIMENSIONS, bool)
        self.run_bits[dims(self.runs)] = True
        #: Short items by their number of words: hash of all of them -> items.
        self.short: dict[int, dict[int, list[int]]] = {}
        for k, (_, text, answer) in enumerate(rows):
            n = len(self.words[k])
            own = answer != last_sentence(text) and len(self.answers[k]) > 0
            if (1 if own else LEAST_EXACT) <= n < LEAST_WORDS:
                self.short.setdefault(n, {}).setdefault(int(runs(self.words[k], n)[0]), []).append(k)

    @property
    def size(self) -> int:
        """Bytes of the tables."""
        return self.table.nbytes + self.vectors.nbytes + self.runs.nbytes + self.run_owner.nbytes

    def short_places(self, row: np.ndarray, word: np.ndarray) -> Iterator[tuple[int, int]]:
        """(place of a word, short item) where all words of the item stand in a row."""
        for n, items in self.short.items():
            if len(word) < n:
                continue
            found = runs(word, n)
            at = np.flatnonzero(np.isin(found, np.fromiter(items, np.uint64, len(items))) & (row[: len(found)] == row[n - 1 :]))
            for place in at.tolist():
                for k in items[int(found[place])]:
                    if np.array_equal(word[place : place + n], self.words[k]):
                        yield place, k

    def run_places(self, row: np.ndarray, word: np.ndarray) -> Iterator[tuple[int, int]]:
        """(place of a word, weak item) where a run of the item begins; one of each WINDOW places."""
        if not len(self.runs) or len(word) < RUN:
            return
        found = runs(word)
        at = np.flatnonzero(self.run_bits[dims(found)] & (row[: len(found)] == row[RUN - 1 :]))
        low, high = np.searchsorted(self.runs, found[at]), np.searchsorted(self.runs, found[at], side="right")
        seen: set[tuple[int, int, int]] = set()
        for place, a, b in zip(at.tolist(), low.tolist(), high.tolist(), strict=True):
            for k in self.run_owner[a:b].tolist():
                key = (int(row[place]), place // WINDOW, k)
                if key not in seen:
                    seen.add(key)
                    yield place, k

    def fit(self, spark: SparkSession, weight: np.ndarray) -> None:
        if not len(self.used):
            return
        directions = basis(spark, self.matrix, len(self.used))
        self.table = (directions * weight[self.used][:, None]).astype(np.float32)
        latent = np.stack([x @ directions[at] for at, x in self.matrix])
        self.vectors = (latent / np.maximum(np.linalg.norm(latent, axis=1, keepdims=True), 1e-12)).astype(np.float32)


def item_windows(words: int) -> list[int]:
    """Starts of an item's passages; none for items that are too short."""
    if words < LEAST_WORDS:
        return []
    last = max(0, words - WINDOW)
    return [*range(0, last, HALF), last]


def _by_row(row: np.ndarray, word: np.ndarray, rows: int) -> list[np.ndarray]:
    return np.split(word, np.searchsorted(row, np.arange(1, rows)))


def checked(item: list[int], need: Counter, answer: list[int], around: list[int]) -> tuple[float, float, bool]:
    """(share of the item's words in the common subsequence, of the answer's, contaminated).

    ``need`` counts the item's words. A share below PARAPHRASE may be the bound on it.
    """
    near = [x for x in around if x in need]  # other words can't be in a common subsequence
    bound = sum(min(n, need[x]) for x, n in Counter(near).items())
    if bound < PARAPHRASE * len(item):
        return bound / len(item), 0.0, False
    share = common_subsequence(item, near) / len(item)
    if share < PARAPHRASE:
        return share, 0.0, False
    told = common_subsequence(answer, around) / len(answer) if answer else 1.0
    return share, told, share >= COPY or told >= ANSWER


def _matches(text: pa.Array, items: Items, weight: np.ndarray) -> dict[tuple[int, int], tuple]:
    """(row, item) -> (cosine, lcs, answer, contaminated) of the best place, for all candidates of a batch."""
    lengths = [len(w) for w in items.words]
    row, word = hashed_words(text)
    passages = Passages(row, word, len(text))
    best: dict[tuple[int, int], tuple] = {}

    def compare(r: int, k: int, start: int, cosine: float | None) -> None:
        key = (r, k)
        if key in best and best[key][1:3] == (1.0, 1.0):
            return  # no place is better
        low = max(passages.first_word[r], start - lengths[k])
        high = min(passages.first_word[r] + passages.counts[r], start + WINDOW + lengths[k])
        got = checked(*items.told[k], passages.words[low:high].tolist())
        if key not in best or (got[2], got[0], got[1]) > (best[key][3], best[key][1], best[key][2]):
            best[key] = (cosine, *got)

    if len(items.vectors):
        _latent(passages, items, weight, compare)
    for place, k in items.run_places(row, word):
        # the first of the places that one of WINDOW stands for, so that all of them are in the surroundings
        compare(int(row[place]), k, place, None)
    for place, k in items.short_places(row, word):
        r = int(row[place])
        low = max(passages.first_word[r], place - WINDOW)
        answer = items.told[k][2]
        around = passages.words[low : min(passages.first_word[r] + passages.counts[r], place + 2 * WINDOW)].tolist()
        told = common_subsequence(answer, around) / len(answer) if answer else 1.0
        if (r, k) not in best or told > best[r, k][2]:
            best[r, k] = (None, 1.0, told, told >= ANSWER)
    return best


def _latent(passages: Passages, items: Items, weight: np.ndarray, compare: Callable[[int, int, int, float], None]) -> None:
    """Compares the items and places whose passages are near by cosine."""
    vectors, size = passages.projected(items.column, items.table), passages.lengths(weight)
    # the cosine is at most the projection's length by the vector's
    able = np.flatnonzero((size > 0) & (np.linalg.norm(vectors, axis=1) >= CANDIDATE * size))
    for a in range(0, len(able), ROUND):
        part = able[a : a + ROUND]
        cosine = vectors[part] @ items.vectors.T / size[part][:, None]
        for w, q in np.argwhere(cosine >= CANDIDATE).tolist():
            k = items.owner[q]
            half = passages.window[part[w]]
            compare(int(passages.half_row[half]), k, int(passages.half_start[half]), float(cosine[w, q]))


def _search(docs: DataFrame, group: list[Items], weight: np.ndarray, only_found: bool) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out: dict[str, list] = {k: [] for k in ("doc_id", "item_id", "cosine", "lcs", "answer", "contaminated")}
            names = batch.column("doc_id").to_pylist()
            for items in group:
                for (r, k), (cosine, share, told, found) in sorted(_matches(batch.column("text"), items, weight).items()):
                    if found or not only_found:
                        for c, v in zip(out, (names[r], items.ids[k], cosine, share, told, found), strict=True):
                            out[c].append(v)
            kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.bool_())
            yield pa.RecordBatch.from_pydict({c: pa.array(v, t) for (c, v), t in zip(out.items(), kinds, strict=True)})

    return docs.mapInArrow(run, "doc_id long, item_id long, cosine double, lcs double, answer double, contaminated boolean")


def blocks(rows: Iterator[tuple]) -> Iterator[list[tuple]]:
    """Items in lists of at most BLOCK_PASSAGES passages (a long item may be more on its own)."""
    block, size = [], 0
    for row in rows:
        more = len(item_windows(len(hashed_words(pa.array([row[1]]))[1])))
        if block and size + more > BLOCK_PASSAGES:
            yield block
            block, size = [], 0
        block.append(row)
        size += more
    if block:
        yield block


def last_sentence(text: str) -> str:
    parts = [p for p in re.split(r"[.!?\n]+", text) if p.strip()]
    return parts[-1] if parts else ""


def indexed(docs: DataFrame, benchmark: DataFrame) -> Iterator[tuple[list[Items], np.ndarray]]:
    """The fitted blocks of the benchmark (item_id, text, perhaps answer), those of one pass together, with the weights of words."""
    answer = F.col("answer") if "answer" in benchmark.columns else F.lit(None).cast("string")
    benchmark = benchmark.select("item_id", "text", answer.alias("answer"))
    frequency, n = document_frequency(docs)
    # items of the same words count once, or repeated items would be made of stop words
    plain = F.trim(F.regexp_replace(F.lower("text"), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " "))
    in_items, n_items = document_frequency(benchmark.select(plain.alias("text")).distinct())
    weight = np.clip(np.log((n + 1.0) / (frequency + 1.0)), FLOOR, CEILING)
    weight[in_items > max(STOP_SHARE * n_items, STOP_ITEMS)] = 0
    weight = weight.astype(np.float32)
    rows = ((r["item_id"], r["text"] or "", r["answer"] or last_sentence(r["text"] or "")) for r in benchmark.toLocalIterator())
    group: list[Items] = []
    for block in blocks(rows):
        items = Items(block, weight)
        items.fit(docs.sparkSession, weight)
        if len(items.vectors) or items.weak or items.short:
            if group and sum(i.size for i in group) + items.size > PASS_BYTES:
                yield group, weight
                group = []
            group.append(items)
    if group:
        yield group, weight


def contaminated(docs: DataFrame, benchmark: DataFrame, only_found: bool = True) -> DataFrame:
    """(doc_id, item_id) pairs: cosine, lcs and answer shares, contaminated.

    ``docs`` has doc_id and text, ``benchmark`` item_id, text and perhaps answer.
    With ``only_found`` false, candidates that the checks clear are returned too.
    """
    docs = columns(docs, "doc_id", "text")
    schema = "doc_id long, item_id long, cosine double, lcs double, answer double, contaminated boolean"
    out = docs.sparkSession.createDataFrame([], schema)
    for group, weight in indexed(docs, benchmark):
        out = out.unionByName(_search(docs, group, weight, only_found))
    return out


def without_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` (any columns, among them text) that hold no benchmark item; nothing is shuffled."""

    def kept(df: DataFrame, group: list[Items], weight: np.ndarray) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches, "carried"):
                text = field(batch, "carried", "text")
                bad = {r for items in group for (r, _), got in _matches(text, items, weight).items() if got[3]}
                yield batch.filter(pa.array([r not in bad for r in range(batch.num_rows)]))

        return df.mapInArrow(run, df.schema)

    # the row travels as one struct, whatever its columns are called
    out = docs.select(F.struct("*").alias("carried"))
    for group, weight in indexed(docs, benchmark):
        out = kept(out, group, weight)
    return out.select("carried.*")


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


QUERIES = {"op4_decontamination": op4_decontamination}
