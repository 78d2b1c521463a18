"""Masked pseudo-likelihood scores by a bidirectional window network (operator 4).

Every token is predicted from the tokens on both sides: embeddings of the `WINDOW` tokens
before and after it are weighted by place, summed and squashed; a two-level softmax (class,
then word in the class) gives its probability. A document's score is the sum of the log
probabilities of all its tokens, each masked in turn.

Tokens are words by digest: the most frequent ones of the whole corpus have ids of their own
in the network, the others share its hash buckets, and a word's probability there is that of
its bucket times its share of the bucket's count. The counts of all words stay a table, which
is joined to the tokens by digest. The counts and the training cover every token of every
document. Texts become ids once, in a table that training and scoring read. Training is data
parallel: the documents are dealt by a hash into `rounds`, and those of a round into parts of
about PART tokens. A copy of the network is trained on each part in numpy, and the
copies are averaged by tokens, block by block and in two shuffled steps, so only the averaged
network (some 40,000 numbers), the most frequent words and the buckets' sums ever reach the driver.
Parts and their order hang on the rows and their number alone, so scores do not change with
the files, partitions or machines that the rows come from.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from footfall.llm.shingles import slices, words
from footfall.llm.tables import hand_over, text_or_empty

WINDOW = 2
PLACES = [*range(-WINDOW, 0), *range(1, WINDOW + 1)]
CLASSES, IN_CLASS = 32, 32
SIZE = CLASSES * IN_CLASS
BUCKETS = 64
#: Words with an id of their own; the buckets' ids follow.
TOP = SIZE - BUCKETS
DIM = 16
#: Tokens of a training or scoring step.
STEP = 8192
RATE = 0.1
#: Log counts are summed as whole numbers of this fraction, so that no order of rows matters.
UNITS = 1 << 32
#: Numbers of a parameter block, and how many partial averages a block has.
BLOCK, PARTIALS = 4096, 64
#: Tokens that one copy of the network is trained on in a round.
PART = 2_000_000
#: Distinct words that a task holds before it passes their counts on.
HELD_WORDS = 500_000

SHAPES = {
    "embed": (SIZE + 1, DIM), "place": (len(PLACES), DIM), "hidden": (DIM,),
    "class_w": (DIM, CLASSES), "class_b": (CLASSES,),
    "word_w": (CLASSES, DIM, IN_CLASS), "word_b": (CLASSES, IN_CLASS),
}


def unpack(flat: np.ndarray) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for name, shape in SHAPES.items():
        n = int(np.prod(shape))
        out[name] = flat[at : at + n].reshape(shape)
        at += n
    return out


def initial(counts: np.ndarray, seed: int = 11) -> np.ndarray:
    """Small random weights; biases start from the unigram counts."""
    rng = np.random.default_rng(seed)
    net = {n: rng.normal(0, 0.1, s).astype(np.float32) for n, s in SHAPES.items()}
    net["place"][:] = 1.0 + net["place"]
    net["hidden"][:] = 0
    share = (counts.reshape(CLASSES, IN_CLASS) + 1.0) / (counts.sum() + SIZE)
    net["class_b"][:] = np.log(share.sum(1))
    net["word_b"][:] = np.log(share / share.sum(1, keepdims=True))
    return np.concatenate([net[n].ravel() for n in SHAPES])


def to_ids(digests: np.ndarray, vocabulary: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Token ids: the rank of frequent words, a hash bucket after them for the others."""
    ids = TOP + (digests % np.uint64(BUCKETS)).astype(np.int64)
    if len(vocabulary):
        at = np.minimum(np.searchsorted(vocabulary, digests), len(vocabulary) - 1)
        known = vocabulary[at] == digests
        ids[known] = order[at[known]]
    return ids


def padded(ids: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All tokens of some texts in a row with gaps of `WINDOW` padding ids between texts,
    and the place of each token in it."""
    lengths = np.diff(at)
    place = np.arange(len(ids)) + WINDOW + np.repeat(np.arange(len(lengths)) * WINDOW, lengths)
    flat = np.full(len(ids) + WINDOW * (len(lengths) + 1), SIZE, np.int64)
    flat[place] = ids
    return flat, place


def forward(net, flat: np.ndarray, place: np.ndarray):
    """Hidden states of the tokens at `place`, from their neighbours only."""
    around = [flat[place + k] for k in PLACES]
    total = net["hidden"] + sum(net["embed"][w] * net["place"][k] for k, w in enumerate(around))
    return np.tanh(total), around


def _log_softmax(x: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Log probability of column `at` in each row."""
    x = x - x.max(axis=1, keepdims=True)
    return x[np.arange(len(x)), at] - np.log(np.exp(x).sum(axis=1))


def _missed(x: np.ndarray, at: np.ndarray, share: np.float32) -> np.ndarray:
    """`share` of the gradient at the scores x of the negative log probability of column `at`."""
    x -= x.max(axis=1, keepdims=True)
    np.exp(x, out=x)
    x *= share / x.sum(axis=1, keepdims=True)
    x[np.arange(len(x)), at] -= share
    return x


def _by_class(classes: np.ndarray):
    """(class, tokens of it) for the classes that occur."""
    order = np.argsort(classes, kind="stable")
    cuts = np.searchsorted(classes[order], np.arange(CLASSES + 1))
    for c in range(CLASSES):
        if cuts[c] < cuts[c + 1]:
            yield c, order[cuts[c] : cuts[c + 1]]


def log_probs(net, flat: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Log probability of each token given both sides."""
    out = np.empty(len(place), np.float64)
    for a in range(0, len(place), STEP):
        some = place[a : a + STEP]
        h, _ = forward(net, flat, some)
        target = flat[some]
        classes, word = target // IN_CLASS, target % IN_CLASS
        lp = _log_softmax(h @ net["class_w"] + net["class_b"], classes)
        for c, rows in _by_class(classes):
            lp[rows] += _log_softmax(h[rows] @ net["word_w"][c] + net["word_b"][c], word[rows])
        out[a : a + STEP] = lp
    return out


def gradients(net, flat: np.ndarray, place: np.ndarray) -> dict[str, np.ndarray]:
    """Mean gradient of the negative log probability over the tokens at `place`."""
    h, around = forward(net, flat, place)
    target = flat[place]
    classes, word = target // IN_CLASS, target % IN_CLASS
    share = np.float32(1 / len(place))
    g = {}
    d = _missed(h @ net["class_w"] + net["class_b"], classes, share)
    g["class_w"], g["class_b"] = h.T @ d, d.sum(0)
    dh = d @ net["class_w"].T
    g["word_w"], g["word_b"] = np.zeros_like(net["word_w"]), np.zeros_like(net["word_b"])
    for c, rows in _by_class(classes):
        own = h[rows]
        d = _missed(own @ net["word_w"][c] + net["word_b"][c], word[rows], share)
        g["word_w"][c], g["word_b"][c] = own.T @ d, d.sum(0)
        dh[rows] += d @ net["word_w"][c].T
    dh *= 1 - h * h
    g["hidden"] = dh.sum(0)
    # per place, the sums of dh by the word there give both gradients
    columns = np.ascontiguousarray(dh.T, np.float64)
    by_word = np.array([[np.bincount(w, x, SIZE + 1) for x in columns] for w in around], np.float32).transpose(0, 2, 1)
    g["place"] = (by_word * net["embed"]).sum(1)
    g["embed"] = (by_word * net["place"][:, None]).sum(0)
    return g


def train(flat_net: np.ndarray, texts) -> tuple[np.ndarray, int]:
    """One pass of Adagrad steps over (flat ids, places) pairs; the net and its tokens."""
    flat_net = flat_net.copy()
    net = unpack(flat_net)
    seen = {n: np.full(SHAPES[n], 1e-8, np.float32) for n in SHAPES}
    tokens = 0
    for flat, place in texts:
        for a in range(0, len(place), STEP):
            some = place[a : a + STEP]
            for name, g in gradients(net, flat, some).items():
                seen[name] += g * g
                net[name] -= RATE * g / np.sqrt(seen[name])
            tokens += len(some)
    return flat_net, tokens


def _count(batches):
    """(word digest, count) of a task's texts, combined as far as memory is bounded."""
    held, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def out():
        return pa.record_batch([pa.array(held.view(np.int64)), pa.array(counts)], names=["word", "n"])

    for batch in batches:
        for _, data, offsets in slices(batch.column("text")):
            new, n = np.unique(words(data, offsets)[0], return_counts=True)
            both, where = np.unique(np.concatenate([held, new]), return_inverse=True)
            total = np.bincount(where, weights=np.concatenate([counts, n])).astype(np.int64)
            held, counts = both, total
            if len(held) > HELD_WORDS:
                yield out()
                held, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    if len(held):
        yield out()


def word_counts(docs: DataFrame) -> DataFrame:
    """How often each word occurs in all texts: word (its digest), n."""
    counts = docs.mapInArrow(_count, "word BIGINT, n BIGINT").groupBy("word").agg(F.sum("n").alias("n"))
    return hand_over(counts, "lm-words")


def vocabulary(counts: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Digests of the most frequent words (sorted), their ids by frequency, counts by id."""
    found = counts.orderBy(F.desc("n"), "word").limit(TOP).collect()
    bucket = F.pmod(F.col("word"), F.lit(BUCKETS))  # two's complement: the same as unsigned
    all_rest = {r["b"]: r["n"] for r in counts.groupBy(bucket.alias("b")).agg(F.sum("n").alias("n")).collect()}
    by_id = np.zeros(SIZE, np.float64)
    for b, n in all_rest.items():
        by_id[TOP + b] = n
    for i, r in enumerate(found):
        by_id[i] = r["n"]
        by_id[TOP + r["word"] % BUCKETS] -= r["n"]
    digests = np.array([r["word"] for r in found], np.int64).view(np.uint64)
    order = np.argsort(digests)
    return digests[order], order.astype(np.int64), np.maximum(by_id, 0)


def _ids(known: np.ndarray, order: np.ndarray):
    """The ids of each text's words, and the digests of those that share a bucket."""
    def run(batches):
        for batch in batches:
            for row, data, offsets in slices(batch.column("text")):
                digests, at = words(data, offsets)
                ids = to_ids(digests, known, order)
                rare = ids >= TOP
                ends = np.concatenate([[0], np.cumsum(rare)])[at]
                n = len(at) - 1
                yield pa.record_batch(
                    [
                        batch.column("doc_id").slice(row, n), batch.column("deal").slice(row, n), pa.array(np.diff(at), pa.int64()),
                        pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids.astype(np.int16))),
                        pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(digests[rare].view(np.int64))),
                    ],
                    names=["doc_id", "deal", "n_tokens", "ids", "words"],
                )

    return run


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All ids of a batch in a row, and where each text's begin."""
    at = column.offsets.to_numpy().astype(np.int64)
    return column.values.to_numpy(zero_copy_only=False)[at[0] : at[-1]].astype(np.int64), at - at[0]


def _train(net: np.ndarray):
    def run(batches):
        after, tokens = train(net, (padded(*_flat(batch.column("ids"))) for batch in batches))
        if tokens:
            blocks = [after[a : a + BLOCK] for a in range(0, len(after), BLOCK)]
            yield pa.record_batch(
                [
                    pa.array(range(len(blocks)), pa.int32()),
                    pa.array([float(tokens)] * len(blocks), pa.float64()),
                    pa.array([b.astype(np.float64) for b in blocks], pa.list_(pa.float64())),
                ],
                names=["block", "tokens", "numbers"],
            )

    return run


def _mean(table: pa.Table) -> pa.Table:
    """Average of a block's copies by tokens, in an order that does not depend on the shuffle."""
    table = table.sort_by([("tokens", "ascending"), ("part", "ascending")])
    tokens = table.column("tokens").to_numpy()
    numbers = np.stack([np.asarray(x.values) for chunk in table.column("numbers").chunks for x in chunk])
    mean = (numbers * tokens[:, None]).sum(0) / tokens.sum()
    return pa.table({
        "block": table.column("block").slice(0, 1), "part": table.column("part").slice(0, 1),
        "tokens": pa.array([float(tokens.sum())]), "numbers": pa.array([mean], pa.list_(pa.float64())),
    })


def fit(docs: DataFrame, rounds: int = 4):
    """The network, trained on every token of `docs` (doc_id, text) once; the counts of its ids,
    the table of all words' counts, and the texts as ids (doc_id, deal, n_tokens, ids, words, row)."""
    counts = word_counts(docs.select("text"))
    known, order, by_id = vocabulary(counts)
    net = initial(by_id).astype(np.float32)
    dealt = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("deal"), "text")
    texts = hand_over(
        dealt.mapInArrow(
            _ids(known, order), "doc_id BIGINT, deal BIGINT, n_tokens BIGINT, ids ARRAY<SMALLINT>, words ARRAY<BIGINT>"
        ).withColumns({"row": F.monotonically_increasing_id(), "turn": F.pmod("deal", F.lit(rounds)).cast("int")}),
        "lm-ids", by="turn",
    )
    parts = max(1, -(-int(by_id.sum()) // (rounds * PART)))
    kind = "block INT, part INT, tokens DOUBLE, numbers ARRAY<DOUBLE>"
    for i in range(rounds):
        # ids only, dealt by the row's own hash and trained on in its order
        turn = texts.where(F.col("turn") == i).select("deal", "ids")
        turn = turn.repartition(parts, F.expr(f"deal div {rounds}")).sortWithinPartitions("deal")
        copies = turn.mapInArrow(_train(net), "block INT, tokens DOUBLE, numbers ARRAY<DOUBLE>")
        part = F.pmod(F.spark_partition_id(), F.lit(PARTIALS)).cast("int")
        copies = copies.select("block", part.alias("part"), "tokens", "numbers")
        halves = copies.groupBy("block", "part").applyInArrow(_mean, kind)
        means = {r["block"]: r["numbers"] for r in halves.groupBy("block").applyInArrow(_mean, kind).collect()}
        if not means:
            continue
        net = np.concatenate([np.array(means[b]) for b in sorted(means)]).astype(np.float32)
    return (net, by_id), counts, texts


def _score(model):
    def run(batches):
        flat_net, by_id = model
        net = unpack(flat_net)
        share = np.zeros(SIZE)  # the part of a word's share that its bucket gives
        share[TOP:] = -np.log(np.maximum(by_id[TOP:], 1))
        for batch in batches:
            ids, at = _flat(batch.column("ids"))
            flat, place = padded(ids, at)
            sums = np.concatenate([[0.0], np.cumsum(log_probs(net, flat, place) + share[ids])])
            yield pa.record_batch(
                [batch.column("doc_id"), batch.column("n_tokens"), batch.column("row"), pa.array(sums[at[1:]] - sums[at[:-1]])],
                names=["doc_id", "n_tokens", "row", "total"],
            )

    return run


def score(docs: DataFrame, rounds: int = 4) -> DataFrame:
    """One row per document: doc_id, n_tokens, log_likelihood, mean_log_prob.

    Null or empty texts have no tokens: likelihood 0 and a null mean. Null and repeated ids are
    rows like any other; an empty table gives an empty result; other columns are ignored. A
    table without any word scores by an untrained network.

    The network is run once; what it leaves open, the counts of the words in its buckets, comes
    from a join of (row, word) with the table of counts. Words that occur once add nothing.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("text"))
    model, counts, texts = fit(rows, rounds)
    scored = texts.select("doc_id", "n_tokens", "row", "ids").mapInArrow(
        _score(model), "doc_id BIGINT, n_tokens BIGINT, row BIGINT, total DOUBLE"
    )
    part = F.round(F.log("n") * UNITS).cast("bigint")
    # the counts grow with the corpus and are never broadcast
    counted = counts.where("n > 1").select("word", part.alias("part")).hint("merge")
    added = (
        texts.select("row", F.explode("words").alias("word")).join(counted, "word")
        .groupBy("row").agg(F.sum("part").alias("added"))
    )
    total = F.col("total") + F.coalesce("added", F.lit(0)) / UNITS
    return scored.join(added, "row", "left").select(
        "doc_id", "n_tokens", F.round(total, 4).alias("log_likelihood"),
        F.when(F.col("n_tokens") > 0, F.round(total / F.col("n_tokens"), 6)).alias("mean_log_prob"),
    )
