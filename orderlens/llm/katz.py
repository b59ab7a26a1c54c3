r"""Language-model scoring with Katz backoff (bigrams over unigrams).

Tokens are the words ``[^\x20\x09-\x0D]+`` of a text with A-Z lower-cased, then
one end.  Counts r <= K are discounted by Good-Turing (Katz's d_r, from counts
of counts); with the mass that this frees a history backs off to the unigram,
with the weight that makes its distribution sum to exactly one over vocabulary
and <unk>; the unigram's freed mass is the probability of <unk>.

    P(w|h) = d_c c(h,w) / c(h)            if the pair was seen
           = alpha(h) P(w)                otherwise, alpha = 1 for an unseen history
    alpha(h) = (1 - sum seen P(w|h)) / (1 - sum seen P(w))

How it runs at any size:

* Texts are packed once into blocks of about ``BLOCK_CHARS`` characters: a block has its own
  small vocabulary and its tokens as numbers, written to the shared folder.
* The words of all blocks are joined (as whole bytes) with the counted
  vocabulary, which is sorted by falling count and numbered; a word's count is
  thereby a step function of its number with at most sqrt(2 N) steps, the only
  thing about words that is sent everywhere.
* Each block sends its distinct pairs with its training counts, packed, to the
  buckets of the bigram table (by history; a history with more than its share of
  all tokens is dealt over several).  A bucket adds up the counts, and answers
  each block with the counts of its pairs and, per history, what alpha needs.
* Each block looks up its answers and scores its documents token by token.

No row per token is ever shuffled, and no table of words or pairs is gathered
in one place.

Defined cases: a null text counts as empty and has the end token only; without
training rows every token is <unk> with probability one; a d_r outside (0, 1]
(sparse counts of counts) is one; a history whose discounts free no mass, and
unigrams likewise, count one more unseen token in the denominator; repeated
rows count and are scored as often as they occur; very long texts are counted and scored whole; a null id counts as the empty
text when rows are dealt to training; an empty table gives no rows; further
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderlens.llm.common import crc_mod, shuffle_width, table
from orderlens.plans.materialize import discard, materialize

K = 5
BLOCK_CHARS = 1 << 23
BUCKET_TOKENS = 1 << 21
END = 0  # local number of the end token

BLOCKS = ("doc_ids array<bigint>, held array<boolean>, lengths binary, tokens binary, words binary, counts binary")
REQUESTS = "bucket int, block bigint, keys binary, counts binary"
ANSWERS = "block bigint, bucket int, counts binary, stats binary, sums binary, hot binary, hot_sums binary, seen array<bigint>"
SCORES = ("doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, "
          "score double")


def pack(values: np.ndarray) -> bytes:
    """Unsigned integers (or floats) as zstd over byte planes."""
    values = np.ascontiguousarray(values)
    if values.dtype.kind != "f":
        top = int(values.max()) if len(values) else 0
        values = values.astype(next(t for t in ("<u1", "<u2", "<u4", "<u8") if top <= np.iinfo(t).max))
    planes = values.view(np.uint8).reshape(len(values), values.itemsize).T.tobytes()
    return values.dtype.str.encode() + zstandard.ZstdCompressor(level=3).compress(planes)


def unpack(data: bytes) -> np.ndarray:
    kind = np.dtype(data[:3].decode())
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data[3:]), dtype=np.uint8)
    values = np.ascontiguousarray(planes.reshape(kind.itemsize, -1).T).view(kind).ravel()
    return values if kind.kind == "f" else values.astype(np.int64)


def _deal(x: np.ndarray) -> np.ndarray:
    """A 63-bit hash of int64 numbers."""
    x = x.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(1)).astype(np.int64)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number: dict[bytes, int] = {b"": END}
    ids, held, lengths, tokens, room = [], [], [], [], 0

    def block() -> pa.RecordBatch:
        flat = np.concatenate(tokens)
        train = np.repeat(~np.array(held), lengths)
        counts = np.bincount(flat[train], minlength=len(number))
        return pa.RecordBatch.from_arrays(
            [pa.array([ids], pa.list_(pa.int64())), pa.array([held], pa.list_(pa.bool_())),
             *[pa.array([x], pa.binary()) for x in (pack(np.array(lengths)), pack(flat),
                                                    zstandard.ZstdCompressor().compress(b" ".join(number)), pack(counts))]],
            names=["doc_ids", "held", "lengths", "tokens", "words", "counts"])

    for batch in batches:
        for doc_id, out, text in zip(*batch.columns):
            words = (text.as_py() or "").encode("utf-8", "replace").lower().split()
            line = [number.setdefault(w, len(number)) for w in words]
            line.append(END)
            tokens.append(np.array(line, dtype=np.int64))
            ids.append(doc_id.as_py())
            held.append(out.as_py())
            lengths.append(len(line))
            room += len(text.as_py() or "") + 1
            if room >= BLOCK_CHARS:
                yield block()
                number, room = {b"": END}, 0
                ids, held, lengths, tokens = [], [], [], []
    if ids:
        yield block()


def _vocabulary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block, words, counts in zip(*batch.columns):
            words = zstandard.ZstdDecompressor().decompress(words.as_py()).split(b" ")
            counts = unpack(counts.as_py())
            order = np.array(sorted(range(len(words)), key=words.__getitem__))  # equal starts compress
            for at in range(0, len(words), 1 << 16):
                part = order[at:at + (1 << 16)]
                yield pa.record_batch([pa.array([block.as_py()] * len(part), pa.int64()), pa.array(part, pa.int32()),
                                       pa.array([words[i] for i in part], pa.binary()), pa.array(counts[part], pa.int64())],
                                      names=["block", "place", "word", "n"])


@dataclass
class Discounts:
    """Good-Turing discounts of counts 1..K from counts of counts 1..K+1."""

    seen: list[int]
    ratio: np.ndarray = field(init=False)  # by count, ratio[0] unused, ratio[K+1] = 1 for all beyond

    def __post_init__(self):
        n = [0, *self.seen]
        self.ratio = np.ones(K + 2)
        common = (K + 1) * n[K + 1] / n[1] if n[1] else 1.0
        for r in range(1, K + 1):
            if n[r] and common != 1.0:
                d = ((r + 1) * n[r + 1] / (r * n[r]) - common) / (1 - common)
                self.ratio[r] = d if 0.0 < d <= 1.0 else 1.0

    def of(self, counts: np.ndarray) -> np.ndarray:
        return self.ratio[np.minimum(counts, K + 1)]


@dataclass
class Unigrams:
    """The numbered vocabulary: counts fall in steps; number ``size`` stands for the text's start."""

    steps: list[tuple[int, int]]  # (count, how many words), counts falling
    starts: int  # training documents

    def __post_init__(self):
        self.values = np.array([c for c, _ in self.steps], dtype=np.int64)
        self.upto = np.cumsum([n for _, n in self.steps]).astype(np.int64) if self.steps else np.zeros(0, dtype=np.int64)
        self.size = int(self.upto[-1]) if self.steps else 0
        self.tokens = int(sum(c * n for c, n in self.steps))
        held = dict(self.steps)
        self.discounts = Discounts([held.get(r, 0) for r in range(1, K + 2)])
        kept = sum(float(self.discounts.of(np.array([c]))[0]) * c * n for c, n in self.steps)
        self.whole = float(self.tokens) if kept < self.tokens - 1e-9 else self.tokens + 1.0
        self.unknown = 1.0 - kept / self.whole if self.tokens else 1.0

    def counts(self, numbers: np.ndarray) -> np.ndarray:
        """Training counts of words by number; -1 is an unknown word, ``size`` the start."""
        at = np.searchsorted(self.upto, np.maximum(numbers, 0), side="right")
        found = np.r_[self.values, self.starts][at] if len(self.values) else np.full(len(numbers), self.starts)
        return np.where(numbers < 0, 0, found)

    def prob(self, numbers: np.ndarray) -> np.ndarray:
        c = self.counts(numbers)
        return np.where(numbers < 0, self.unknown, self.discounts.of(c) * c / self.whole)

    def parts(self, numbers: np.ndarray, buckets: int) -> np.ndarray:
        """Over how many buckets a history is dealt: one for each quarter of a bucket's share."""
        return 1 + self.counts(numbers) // max(1, self.tokens // (4 * buckets))


class Pairs:
    """The distinct known pairs of a block, by bucket, and where each token's pair is."""

    def __init__(self, numbers: np.ndarray, lengths: np.ndarray, tokens: np.ndarray, uni: Unigrams, buckets: int):
        self.word = numbers[tokens]
        self.history = np.r_[-1, self.word[:-1]]
        self.history[np.r_[0, np.cumsum(lengths)[:-1]]] = uni.size
        self.known = np.flatnonzero((self.word >= 0) & (self.history >= 0))
        # an unknown word after a known history needs the history's weight: it asks for the pair with the end token
        self.missing = np.flatnonzero((self.word < 0) & (self.history >= 0)) if uni.size else np.zeros(0, dtype=np.int64)
        width = uni.size + 1
        wanted = np.r_[self.history[self.known] * width + self.word[self.known],
                       self.history[self.missing] * width + numbers[END]]
        keys, at = np.unique(wanted, return_inverse=True)
        h, w = keys // width, keys % width
        bucket = (_deal(h) + _deal(keys) % uni.parts(h, buckets)) % buckets
        order = np.argsort(bucket, kind="stable")
        self.keys, self.bucket = keys[order], bucket[order]
        place = np.empty(len(order), dtype=np.int64)
        place[order] = np.arange(len(order))
        self.pair, self.missing_pair = place[at[:len(self.known)]], place[at[len(self.known):]]
        self.cuts = np.flatnonzero(np.r_[True, self.bucket[1:] != self.bucket[:-1], True]) if len(keys) else np.zeros(1, int)

    def slices(self) -> Iterator[tuple[int, int, int]]:
        for a, b in zip(self.cuts, self.cuts[1:]):
            yield int(self.bucket[a]), int(a), int(b)


def _block_row(left: pa.Table) -> tuple:
    row = {c: left.column(c)[0].as_py() for c in left.column_names}
    return row, unpack(row["lengths"]), unpack(row["tokens"])


def _requests(uni: Unigrams, buckets: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        row, lengths, tokens = _block_row(left)
        numbers = np.full(right.num_rows, -1, dtype=np.int64)
        numbers[right.column("place").to_numpy()] = right.column("number").to_numpy()
        pairs = Pairs(numbers, lengths, tokens, uni, buckets)
        train = np.repeat(~np.array(row["held"]), lengths)[pairs.known]
        counts = np.bincount(pairs.pair[train], minlength=len(pairs.keys))
        out = [(-1, row["block"], pack(numbers + 1), b"")]
        for bucket, a, b in pairs.slices():
            out.append((bucket, row["block"], pack(np.diff(pairs.keys[a:b], prepend=0)), pack(counts[a:b])))
        columns = list(zip(*out))
        return pa.table([pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int64()),
                         pa.array(columns[2], pa.binary()), pa.array(columns[3], pa.binary())],
                        names=["bucket", "block", "keys", "counts"])
    return run


def _answers(uni: Unigrams, buckets: int):
    """Adds up a bucket's counts.  ``stats``: per history of a request and count
    r = 1..K how many seen pairs; ``sums``: the unigram mass of its seen words.
    Those of histories dealt over several buckets go to the extra row (block -1)."""
    width = uni.size + 1

    def run(requests: pa.Table) -> pa.Table:
        bucket = requests.column("bucket")[0].as_py()
        blocks = requests.column("block").to_pylist()
        keys = [np.cumsum(unpack(x.as_py())) for x in requests.column("keys")]
        counts = np.concatenate([unpack(x.as_py()) for x in requests.column("counts")])
        table, place = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.bincount(place, weights=counts, minlength=len(table)).astype(np.int64)
        h, w = table // width, table % width
        histories, of = np.unique(h, return_inverse=True)
        stats = np.stack([np.bincount(of[total == r], minlength=len(histories)) for r in range(1, K + 1)], axis=1)
        sums = np.bincount(of, weights=np.where(total > 0, uni.prob(w), 0.0), minlength=len(histories))
        seen = [int((total == r).sum()) for r in range(1, K + 2)]
        hot = uni.parts(histories, buckets) > 1
        out, at = [], 0
        for block, own in zip(blocks, keys):
            mine = np.unique(np.searchsorted(histories, own // width))
            out.append((block, bucket, pack(total[place[at:at + len(own)]]), pack(stats[mine].ravel()), pack(sums[mine]),
                        b"", b"", None))
            at += len(own)
        table_of_hot = np.column_stack([histories[hot], stats[hot]]).astype(np.int64)
        out.append((-1, bucket, b"", b"", b"", pack(table_of_hot.ravel()), pack(sums[hot]), seen))
        columns = list(zip(*out))
        types = [pa.int64(), pa.int32(), *[pa.binary()] * 5, pa.list_(pa.int64())]
        return pa.table([pa.array(c, t) for c, t in zip(columns, types)],
                        names=["block", "bucket", "counts", "stats", "sums", "hot", "hot_sums", "seen"])
    return run


@dataclass
class Backoff:
    """What scoring needs besides the answers: bigram discounts and the split histories."""

    discounts: Discounts
    hot: np.ndarray
    hot_stats: np.ndarray
    hot_sums: np.ndarray


def _scores(uni: Unigrams, back: Backoff, buckets: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        row, lengths, tokens = _block_row(left)
        parts = {b: (x.as_py(), y.as_py(), z.as_py()) for b, x, y, z in zip(
            right.column("bucket").to_pylist(), right.column("counts"), right.column("stats"), right.column("sums"))}
        numbers = unpack(parts[-1][0]) - 1
        pairs = Pairs(numbers, lengths, tokens, uni, buckets)
        width = uni.size + 1
        count = np.zeros(len(pairs.keys), dtype=np.int64)
        freed, sums = np.zeros(len(pairs.keys)), np.zeros(len(pairs.keys))  # by pair: of its history
        weight = (1 - back.discounts.ratio[1:K + 1]) * np.arange(1, K + 1)
        for bucket, a, b in pairs.slices():
            counts, stats, mass = (unpack(x) for x in parts[bucket])
            _, of = np.unique(pairs.keys[a:b] // width, return_inverse=True)
            count[a:b] = counts
            freed[a:b], sums[a:b] = (stats.reshape(-1, K) @ weight)[of], mass[of]
        h = pairs.keys // width
        hot = np.flatnonzero(uni.parts(h, buckets) > 1)
        if len(hot):
            at = np.searchsorted(back.hot, h[hot])
            freed[hot], sums[hot] = back.hot_stats[at] @ weight, back.hot_sums[at]
        prob = uni.prob(pairs.word)
        log_p = np.log10(prob)
        seen_as = uni.counts(h).astype(float)
        whole = np.where(freed > 1e-12, seen_as, seen_as + 1.0)
        alpha = np.where(freed > 1e-12, freed, 1.0) / whole / (1.0 - sums)
        known = prob[pairs.known]
        c, x = count[pairs.pair], pairs.pair
        log_p[pairs.known] = np.log10(np.where(c > 0, back.discounts.of(c) * c / whole[x], alpha[x] * known))
        log_p[pairs.missing] += np.log10(alpha[pairs.missing_pair])
        doc = np.repeat(np.arange(len(lengths)), lengths)
        c1 = uni.counts(pairs.word)
        base = np.log10((c1 + 0.1) / (uni.tokens + 0.1 * (uni.size + 1)))
        n = len(lengths)
        return pa.table([
            pa.array(row["doc_ids"], pa.int64()), pa.array(row["held"], pa.bool_()), pa.array(lengths),
            pa.array(np.bincount(doc, weights=c1 > 0, minlength=n).astype(np.int64)), pa.array(np.full(n, uni.tokens)),
            pa.array(np.bincount(doc, weights=base, minlength=n)), pa.array(np.bincount(doc, weights=log_p, minlength=n))],
            names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])
    return run


def _numbered(words: DataFrame) -> DataFrame:
    """A written table of word, n, m (in falling order of n) -> word, n, number from 0."""
    part, row = F.shiftright("m", 33), F.col("m").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = words.groupBy(part.alias("part")).count()  # a row for each partition of the sort
    before = F.sum("count").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    sizes = sizes.select("part", F.coalesce(before, F.lit(0)).alias("skip"))
    return words.join(F.broadcast(sizes), part == F.col("part")).select("word", "n", (F.col("skip") + row).alias("number"))


def katz_scores(docs: DataFrame, held_out, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Scores of all rows under the model of those where ``held_out`` is false."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), held_out.alias("held"),
                       F.col(text_col).cast("string").alias("text"))
    blocks = materialize(rows.mapInArrow(_blocks, BLOCKS).withColumn("block", F.monotonically_increasing_id()), "katz_blocks")
    starts = blocks.select(F.explode("held").alias("held")).where(~F.col("held")).count()
    local = materialize(blocks.select("block", "words", "counts")
                        .mapInArrow(_vocabulary, "block bigint, place int, word binary, n bigint"), "katz_local")
    sorted_words = materialize(local.where("n > 0").groupBy("word").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "word")
                               .withColumn("m", F.monotonically_increasing_id()), "katz_words")
    words = _numbered(sorted_words)
    steps = sorted(((r["n"], r["count"]) for r in words.groupBy("n").count().collect()), reverse=True)
    uni = Unigrams(steps, starts)
    buckets = max(shuffle_width(spark), -(-uni.tokens // BUCKET_TOKENS))
    numbers = local.select("block", "place", "word").join(words.select("word", "number"), "word", "left").select(
        "block", "place", F.coalesce("number", F.lit(-1)).alias("number"))
    by_block = blocks.select("block", "doc_ids", "held", "lengths", "tokens").groupBy("block")
    requests = materialize(by_block.cogroup(numbers.groupBy("block"))
                           .applyInArrow(_requests(uni, buckets), REQUESTS), "katz_requests")
    own_numbers = materialize(requests.where("bucket = -1").select("block", "keys"), "katz_numbers")
    discard(local)
    discard(sorted_words)
    answers = materialize(requests.where("bucket >= 0").groupBy("bucket")
                          .applyInArrow(_answers(uni, buckets), ANSWERS), "katz_answers")
    discard(requests)
    totals = answers.where("block = -1")
    seen = totals.select(*[F.sum(F.get("seen", F.lit(r))).alias(f"n{r}") for r in range(K + 1)]).first()
    hot: dict[int, list] = {}
    for r in totals.where(F.length("hot_sums") > 0).select("hot", "hot_sums").toLocalIterator():
        # at most eight rows for every bucket: a history's parts are at most its share of all tokens
        for line, mass in zip(unpack(r["hot"]).reshape(-1, K + 1), unpack(r["hot_sums"])):
            own = hot.setdefault(int(line[0]), [np.zeros(K, dtype=np.int64), 0.0])
            own[0] += line[1:]
            own[1] += float(mass)
    split = sorted(hot)
    back = Backoff(Discounts([int(seen[r] or 0) for r in range(K + 1)]), np.array(split, dtype=np.int64),
                   np.array([hot[h][0] for h in split]).reshape(-1, K), np.array([hot[h][1] for h in split]))
    given = (answers.where("block >= 0").select("block", "bucket", "counts", "stats", "sums")
             .unionByName(own_numbers.select(
                 "block", F.lit(-1).alias("bucket"), F.col("keys").alias("counts"), F.lit(b"").alias("stats"),
                 F.lit(b"").alias("sums"))))
    return by_block.cogroup(given.groupBy("block")).applyInArrow(_scores(uni, back, buckets), SCORES)


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return katz_scores(docs, crc_mod(F.col("doc_id"), 10) == 0)
