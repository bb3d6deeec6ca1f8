"""Quality classifier: heuristic labellers, their accuracies by expectation-maximisation, and a hashed linear scorer."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.staging import opened, shipped, stored
from millrace.llm.words import NOT_SPACE, WORDLIKE, hashes_between, mixed, prefix_sums, slices, spans, word_table

BITS = 16  # of the hashed feature space
TRAINING_ROWS = 20_000  # bound of the sample of documents that the scorers are fitted on, about
LABELLED_ROWS = 20_000  # bound of the sample of labelled documents that the lexicon is taken from
LEXICON_WORDS = 200
FIT_ROUNDS = 30
MEMORY = 10  # steps that a round's direction is made from
RIDGE = 1e-4
LEAST_WEIGHT = 0.02  # a posterior label of less weight is left out
LEXICON_DOCS = 4  # toxic documents that a word of the lexicon needs,
LEXICON_SHARE = 0.1  # the share of them,
LEXICON_RATIO = 10  # and how many times it is as frequent there as in others
ROUNDS = 50
THRESHOLD = 0.5

# Words whose use against people counts as a sign of toxicity, and common words of running text.
INSULTS = "clown disgusting dumb fool freak garbage idiot imbecile jerk loser moron pathetic scum stupid trash ugly vermin worthless".split()
RUNNING = ("the of and to in a is that it was for on with as be by at an are or der die und das nicht von sie ist des "
           "sich mit dem ein es auf de la le et les un du une est pour que dans par au el y los del se las para con no su al").split()

BAD, GOOD, ABSTAIN = 1, 0, -1
TASKS = {"junk": 5, "toxic": 4}  # labellers of each; the first is the given label
MARKS = np.ones(256, dtype=bool) & ~WORDLIKE & NOT_SPACE
SYMBOLS = np.zeros(256, dtype=bool)
SYMBOLS[list(b"#*$%&|<>^~=@\\{}[]")] = True


def _hash_of(words: Sequence[str]) -> np.ndarray:
    return np.unique(np.concatenate([word_table(w.encode(), WORDLIKE)[2] for w in words])) if words else np.empty(0, dtype=np.uint64)


@dataclass
class Signs:
    """What the labellers count in one text: its words and marks by hash, each once, and a few sums."""

    words: np.ndarray
    marks: np.ndarray
    n: int
    distinct: int
    symbols: int
    n_bytes: int


def signs(text: bytes | None) -> Signs:
    """One text, worked through piece by piece. Words are runs of letters and digits, marks the runs of other characters."""
    data = (text or b"").lower()  # bytes: only A-Z change
    words, marks, whole, symbols = [], [], [], 0
    for _, piece in slices(data):
        raw = np.frombuffer(piece, dtype=np.uint8)
        sums = prefix_sums(raw)
        words.append(np.unique(hashes_between(sums, *spans(raw, WORDLIKE))))
        runs = spans(raw, MARKS)
        marks.append(np.unique(hashes_between(sums, *runs)))
        whole.append(hashes_between(sums, *spans(raw, NOT_SPACE)))
        bangs = (raw[runs[0]] == 0x21) & (runs[1] - runs[0] > 1)  # "!!"
        symbols += int(SYMBOLS[raw].sum()) + int(bangs.sum())
    none = np.empty(0, dtype=np.uint64)
    joined = lambda parts: np.unique(np.concatenate(parts)) if len(parts) > 1 else parts[0] if parts else none
    n = sum(map(len, whole))
    distinct = len(np.unique(np.concatenate(whole))) if whole else 0
    return Signs(joined(words), joined(marks), n, distinct, symbols, len(data))


def _shared(few: np.ndarray, words: np.ndarray) -> int:
    """How many of ``few`` are in the sorted ``words``."""
    return int((words[np.minimum(np.searchsorted(words, few), len(words) - 1)] == few).sum()) if len(words) else 0


def votes(s: Signs, lexicon: np.ndarray, running: np.ndarray, insults: np.ndarray) -> tuple[int, int]:
    """The labellers' votes on one text for junk and for toxicity, as codes; the given labels join later.

    A code has a digit for each labeller: 0 no opinion, 1 good, 2 bad.
    """
    def code(pairs: list[tuple[bool, bool]]) -> int:
        out = 0
        for bad, good in pairs:
            out = out * 3 + (2 if bad else 1 if good else 0)
        return out

    n = max(s.n, 1)
    density, variety, length = s.symbols / n, s.distinct / n, s.n_bytes / n
    common, rude, learned = (_shared(x, s.words) for x in (running, insults, lexicon))
    junk = code([
        (density > 0.25 and s.n >= 5, density < 0.05),
        (common < 3 and s.n >= 40, common >= 6 and s.n >= 40),
        (variety < 0.25 and s.n >= 40, variety > 0.4 and s.n >= 40),
        (length > 13 and s.n >= 20, length < 10 and s.n >= 20)])
    toxic = code([(rude >= 2, rude == 0), (learned >= 2, learned == 0), (rude >= 1, s.n >= 1)])
    return junk, toxic


def slots(s: Signs, bits: int = BITS) -> np.ndarray:
    """The text's places in the hashed feature space."""
    return np.unique(mixed(np.concatenate([s.words, s.marks ^ np.uint64(0x5bd1e995)])) >> np.uint64(64 - bits)).astype(np.int32)


def toxic_lexicon(docs: DataFrame, labels: DataFrame, rows: int = LABELLED_ROWS, words: int = LEXICON_WORDS) -> np.ndarray:
    """Hashes of the words far more frequent in documents labelled toxic, from at most ``rows`` labels (by hash of the id)."""
    chosen = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = stored(chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows), "weak-labelled")

    total = chosen.agg(F.sum("toxic"), F.sum(1 - F.col("toxic"))).first()
    if not total[0]:
        return np.empty(0, dtype=np.uint64)
    rows = _texts(docs).select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("toxic", "text")  # at most ``rows`` labels

    def counts(texts: DataFrame, among: np.ndarray | None = None) -> DataFrame:
        """(word, n): documents of ``texts`` that each word, or each word ``among`` some, stands in."""
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                found = np.concatenate([np.empty(0, dtype=np.uint64), *(signs(t).words for t in batch["text"])])
                word, n = np.unique(found if among is None else found[np.isin(found, among)], return_counts=True)
                yield pd.DataFrame({"word": word.view(np.int64), "n": n.astype(np.int64)})

        return texts.mapInPandas(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))

    # a word in a tenth of the toxic documents: at most ten times the words of a mean document
    least = max(LEXICON_DOCS, LEXICON_SHARE * total[0])
    often = {r.word: r.n for r in counts(rows.where("toxic = 1").select("text")).where(F.col("n") >= least).collect()}
    among = np.array(sorted(often), dtype=np.int64).view(np.uint64)
    others = {r.word: r.n for r in counts(rows.where("toxic = 0").select("text"), among).collect()}
    ratio = {w: n / total[0] / ((others.get(w, 0) + 0.5) / max(total[1], 1)) for w, n in often.items()}
    best = sorted((w for w in often if ratio[w] > LEXICON_RATIO), key=lambda w: (-ratio[w], w))[:words]
    return np.unique(np.array(best, dtype=np.int64).view(np.uint64))


def fit_accuracies(patterns: Sequence[Sequence[int]], counts: Sequence[int], rounds: int = ROUNDS) -> tuple[np.ndarray, float, np.ndarray]:
    """Expectation-maximisation over vote patterns: (accuracy of each labeller by class, share of bad, posterior by pattern).

    Labellers err independently given the class; an abstention says nothing. Starts from accuracies of 0.8 and a
    tenth of bad documents; a weak prior keeps estimates within (0, 1).
    """
    n = np.asarray(counts, dtype=float)
    v = np.asarray(patterns, dtype=np.int64).reshape(len(n), -1 if len(n) else 0)
    k = v.shape[1]
    accuracy, share, post = np.full((k, 2), 0.8), 0.1, np.zeros(len(n))  # columns: class good, class bad
    for _ in range(rounds):
        logit = np.full(len(n), np.log(share) - np.log1p(-share))
        for j in range(k):
            right_bad, right_good = accuracy[j, 1], accuracy[j, 0]
            logit += np.where(v[:, j] == BAD, np.log(right_bad) - np.log1p(-right_good), 0)
            logit += np.where(v[:, j] == GOOD, np.log1p(-right_bad) - np.log(right_good), 0)
        post = 1 / (1 + np.exp(-np.clip(logit, -50, 50)))
        bad, good = post * n, (1 - post) * n
        share = (bad.sum() + 1) / (n.sum() + 10)
        for j in range(k):
            accuracy[j, 1] = (bad[v[:, j] == BAD].sum() + 4) / (bad[v[:, j] != ABSTAIN].sum() + 5)
            accuracy[j, 0] = (good[v[:, j] == GOOD].sum() + 4) / (good[v[:, j] != ABSTAIN].sum() + 5)
        accuracy = np.clip(accuracy, 0.02, 0.995)
    return accuracy, float(share), post


def _with_labels(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Puts the given labels before the other votes of ``rows`` (doc_id, junk, toxic codes, small): one more digit.

    Labels are one labeller among the others, as they may be wrong. Of several labels for a doc_id the worst counts.
    """
    worst = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("_d")).agg(F.min("quality").alias("_q"), F.max("toxic").alias("_t"))
    digit = lambda c, bad: F.when(F.col(c).isNull(), 0).when(F.col(c) == bad, 2).otherwise(1)
    joined = rows.join(worst, F.col("doc_id") == F.col("_d"), "left")
    return joined.withColumns({
        "junk": F.col("junk") + digit("_q", 0) * 3 ** (TASKS["junk"] - 1),
        "toxic": F.col("toxic") + digit("_t", 1) * 3 ** (TASKS["toxic"] - 1)}).drop("_d", "_q", "_t")


def _digits(code: int, n: int) -> list[int]:
    return [code // 3 ** (n - 1 - j) % 3 - 1 for j in range(n)]


@dataclass
class Classifier:
    """Everything that scoring needs, of a size that does not depend on the documents."""

    lexicon: np.ndarray
    running: np.ndarray
    insults: np.ndarray
    bits: int
    posterior: dict[str, dict[int, float]] = field(default_factory=dict)  # by code, the given label's digit first
    accuracy: dict[str, np.ndarray] = field(default_factory=dict)
    weights: dict[str, tuple[np.ndarray, float] | None] = field(default_factory=dict)  # None: only one class was seen


def _texts(docs: DataFrame) -> DataFrame:
    """doc_id, text and mark: with doc_id it tells rows apart that have the same id but not the same text."""
    text = F.col("text").cast("binary")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), mark_of(F.col("text")).alias("mark"))


def mark_of(text: Column) -> Column:
    return F.xxhash64(text.cast("binary"))


def _posterior(column: str, table: dict[int, float]) -> Column:
    """Looks codes up in at most 3**5 literals."""
    if not table:
        return F.lit(0.0)
    pairs = [x for code, p in sorted(table.items()) for x in (F.lit(code), F.lit(float(p)))]
    return F.try_element_at(F.create_map(*pairs), F.col(column))


def chosen_share(share: float, *columns: str) -> Column:
    """Whether a row is in the sample of this share: by all 64 bits of a hash, so that any share above 2**-64 counts."""
    bound = int(share * 2**64) - 2**63
    return F.lit(True) if bound >= 2**63 else F.xxhash64(*columns, F.lit(7)) < F.lit(bound)


def fit_scorer(at: np.ndarray, ends: np.ndarray, bad: np.ndarray, features: int, rounds: int = FIT_ROUNDS) -> tuple[np.ndarray, float] | None:
    """(weights, intercept) of a logistic scorer, by a quasi-Newton method of limited memory; None if only one class was seen.

    Document i has the features ``at[ends[i - 1]: ends[i]]`` with equal values of norm 1, and counts as a bad document of
    weight ``bad[i]`` and a good one of the rest. The loss is the mean over all weight, and a ridge on the weights.
    """
    sizes = np.diff(ends, prepend=0)
    row = np.repeat(np.arange(len(ends)), sizes)
    value = np.maximum(sizes, 1) ** -0.5
    up, down = np.where(bad > LEAST_WEIGHT, bad, 0.0), np.where(1 - bad > LEAST_WEIGHT, 1 - bad, 0.0)
    total = up.sum() + down.sum()
    if not up.sum() or not down.sum():
        return None

    def loss(x: np.ndarray) -> tuple[float, np.ndarray]:
        z = np.bincount(row, weights=x[at], minlength=len(ends)) * value + x[-1]
        off = (down / (1 + np.exp(-np.clip(z, -500, 500))) - up / (1 + np.exp(np.clip(z, -500, 500)))) / total
        slope = np.append(np.bincount(at, weights=(off * value)[row], minlength=features) + RIDGE * x[:-1], off.sum())
        return float((up * np.logaddexp(0, -z) + down * np.logaddexp(0, z)).sum() / total + RIDGE / 2 * (x[:-1] @ x[:-1])), slope

    x = np.zeros(features + 1)
    x[-1] = np.log(up.sum() / down.sum())
    value_now, slope = loss(x)
    steps: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(rounds):
        direction, scales = -slope, []
        for s, y in reversed(steps):
            scales.append((s @ direction) / (y @ s))
            direction = direction - scales[-1] * y
        if steps:
            s, y = steps[-1]
            direction = direction * ((s @ y) / (y @ y))
        for (s, y), scale in zip(steps, reversed(scales)):
            direction = direction + s * (scale - (y @ direction) / (y @ s))
        size, fall = 1.0, slope @ direction
        while size > 1e-10:
            new, new_slope = loss(x + size * direction)
            if new <= value_now + 1e-4 * size * fall:
                break
            size /= 2
        else:
            break
        s, y = size * direction, new_slope - slope
        if s @ y > 0:
            steps = [*steps, (s, y)][-MEMORY:]
        done = value_now - new < 1e-9 * max(abs(new), 1e-9)
        x, value_now, slope = x + s, new, new_slope
        if done:
            break
    return x[:-1], float(x[-1])


def _fit_scorers(sample: DataFrame, bits: int) -> dict[str, tuple[np.ndarray, float] | None]:
    """Scorers of all tasks, fitted in one task on the bounded sample (doc_id, mark, slots, and a posterior for each task)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots, sizes, bad = [], [], {t: [] for t in TASKS}
        for batch in batches:
            lists = batch.column(batch.schema.get_field_index("slots"))
            slots.append(lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64))
            sizes.append(np.diff(lists.offsets.to_numpy()))
            for t in TASKS:
                bad[t].append(batch.column(batch.schema.get_field_index(t)).to_numpy(zero_copy_only=False))
        if sizes:
            at, ends = np.concatenate(slots), np.cumsum(np.concatenate(sizes))
            found = {t: fit_scorer(at, ends, np.concatenate(bad[t]), 1 << bits) for t in TASKS}
            known = {t: f for t, f in found.items() if f is not None}
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(known), pa.string()), pa.array([w.tolist() for w, _ in known.values()], pa.list_(pa.float64())),
                 pa.array([b for _, b in known.values()], pa.float64())], names=["task", "weights", "intercept"])

    # one place and one order, so that sums and scores are the same in every run
    gathered = sample.repartition(1).sortWithinPartitions("doc_id", "mark")
    rows = gathered.mapInArrow(run, "task string, weights array<double>, intercept double").toArrow()
    found = {r["task"]: (np.array(r["weights"]), r["intercept"]) for r in rows.to_pylist()}
    return {t: found.get(t) for t in TASKS}


def fit(docs: DataFrame, labels: DataFrame, training_rows: int = TRAINING_ROWS, bits: int = BITS) -> Classifier:
    """Labellers vote on all documents, and their accuracies come from the counts of all vote patterns.

    The scorers are fitted on a sample of about ``training_rows`` documents by hash of id and text, whose posterior
    labels count as two weighted rows each. Copies of a document (same id and text) are in it once, so its size
    does not depend on how many rows are copies.
    """
    spark = docs.sparkSession
    fitted = Classifier(toxic_lexicon(docs, labels), _hash_of(RUNNING), _hash_of(INSULTS), bits)
    sent = shipped(spark, fitted)
    texts = _texts(docs).withColumn("chosen", chosen_share(min(1.0, training_rows / max(docs.count(), 1)), "doc_id", "mark"))

    def vote(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        c = opened(sent)
        for batch in batches:
            rows = []
            for text, is_chosen in zip(batch["text"], batch["chosen"]):
                s = signs(text)
                rows.append((*votes(s, c.lexicon, c.running, c.insults), slots(s, c.bits) if is_chosen else None))
            out = pd.DataFrame(rows, columns=["junk", "toxic", "slots"])
            out.insert(0, "doc_id", batch["doc_id"].astype("Int64").to_numpy(dtype=object))
            out.insert(1, "mark", batch["mark"].to_numpy())
            yield out

    voted = texts.mapInPandas(vote, "doc_id long, mark long, junk int, toxic int, slots array<int>")
    voted = stored(_with_labels(stored(voted, "weak-votes"), labels), "weak-labelled-votes")
    for task, n in TASKS.items():
        counted = sorted((r[0], r[1]) for r in voted.groupBy(task).count().collect())  # at most 3**n patterns
        if counted:
            accuracy, _, post = fit_accuracies([_digits(code, n) for code, _ in counted], [k for _, k in counted])
            fitted.accuracy[task], fitted.posterior[task] = accuracy, dict(zip((code for code, _ in counted), post.tolist()))
    sample = voted.where("slots IS NOT NULL").dropDuplicates(["doc_id", "mark"]).select(
        "doc_id", "mark", "slots", *[F.coalesce(_posterior(t, fitted.posterior.get(t, {})), F.lit(0.0)).alias(t) for t in TASKS])
    fitted.weights = _fit_scorers(sample, bits)
    return fitted


def _scorer(sent) -> Callable:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        c = opened(sent)
        for batch in batches:
            rows = []
            for text in batch["text"]:
                s = signs(text)
                at = slots(s, c.bits)
                scores = []
                for task in TASKS:
                    w = c.weights[task]
                    z = 0.0 if w is None else w[1] + (w[0][at].sum() / np.sqrt(len(at)) if len(at) else 0.0)
                    scores.append(0.0 if w is None else float(1 / (1 + np.exp(-np.clip(z, -50, 50)))))
                rows.append((*votes(s, c.lexicon, c.running, c.insults), *scores))
            out = pd.DataFrame(rows, columns=["junk", "toxic", "junk_score", "toxic_score"])
            out.insert(0, "doc_id", batch["doc_id"].astype("Int64").to_numpy(dtype=object))
            out.insert(1, "mark", batch["mark"].to_numpy())
            yield out

    return run


def verdicts(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, training_rows: int = TRAINING_ROWS) -> DataFrame:
    """doc_id, mark, junk_score, toxic_score, junk_posterior, toxic_posterior and kept of every row of ``docs``.

    A document goes if the mean of its score and its posterior exceeds ``threshold`` for junk or for toxicity: the
    scorer generalises beyond the labellers, the posterior holds what they and the given labels saw. Texts are read twice
    (votes, scores) and never shuffled; codes and scores are. Every row gives one row; null and empty texts have
    no features and are judged by the bias and the labels alone. Null or repeated ids, repeated rows and null
    labels are allowed; rows with the same id share its labels. Other columns are ignored.
    """
    fitted = fit(docs, labels, training_rows)
    scored = _texts(docs).mapInPandas(_scorer(shipped(docs.sparkSession, fitted)),
                                      "doc_id long, mark long, junk int, toxic int, junk_score double, toxic_score double")
    rows = _with_labels(stored(scored, "weak-scores"), labels)
    rows = rows.withColumns({f"{t}_posterior": F.coalesce(_posterior(t, fitted.posterior.get(t, {})), F.lit(0.0)) for t in TASKS})
    mean = lambda t: (F.col(f"{t}_score") + F.col(f"{t}_posterior")) / 2
    kept = (mean("junk") <= threshold) & (mean("toxic") <= threshold)
    return rows.select("doc_id", "mark", "junk_score", "toxic_score", "junk_posterior", "toxic_posterior", kept.alias("kept"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rejected rows; all columns stay as they are."""
    bad = stored(verdicts(docs, labels, threshold).where("NOT kept").select(F.col("doc_id").alias("_d"), F.col("mark").alias("_m")).distinct(), "weak-rejected")
    same = docs["doc_id"].cast("long").eqNullSafe(bad["_d"]) & mark_of(docs["text"]).eqNullSafe(bad["_m"])
    return docs.join(bad, same, "left_anti")
