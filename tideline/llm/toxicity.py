"""Toxicity of texts after a noisy-channel restoration of disguised words.

A character trigram model is counted over all documents. Stretches that look disguised (signs or
digits among letters, letters spaced out, letters repeated three times or more) become a lattice: each
sign offers the letters it may stand for or nothing, each long repetition one or two letters, white
space in a spaced stretch a gap or nothing. The
Viterbi path of the lattice under the trigram model and the costs of the disguises is the restored
word. A small logistic model over restored words and stems, fitted on labelled rows, scores the text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.llm.buffers import WHITE, SpanHash, lowered, mixed, slices, text_bytes, unmixed, words
from tideline.llm.tables import fold_of, table, whole_text, written

# Letters that a sign or digit may stand for, most usual first.
LOOKS_LIKE = {
    "0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "*": "abcdefghijklmnopqrstuvwxyz",
}
SYMBOLS = 28  # 0 a gap, 1 to 26 a to z, 27 a byte of any other letter
SUBSTITUTE, WILD, DROP_LETTERLIKE, DROP_MARK, SQUEEZE, GAP = -0.7, -2.5, -9.0, -0.5, -0.3, -4.0
EDGE_MARKS = "!|+(*"  # at the end of a word these are more often punctuation
KEPT_TOKENS, KEPT_LENGTH = 100_000, 40  # readings of longer stretches are not remembered
SPACED_LETTERS = 4
LABELLED_ROWS = 2000
FEWEST_DOCUMENTS, LEAST_EVIDENCE = 4, 20.0
COVER, ALIKE, RIDGE = 3, 0.8, 0.05
STEMS = (5, 6, 7, 8)  # bytes of a word's beginning that count like a word
RATES = (0.0, 0.0025, 0.005, 0.01)  # a word counts once more for each share of the text's words it exceeds


def symbol_table() -> np.ndarray:
    table = np.zeros(256, np.int64)
    table[97:123] = np.arange(1, 27)
    table[65:91] = np.arange(1, 27)
    table[128:] = 27
    return table


def count_trigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """trigram, count of this task; rows of a batch are parted by a gap."""
    codes, total = symbol_table(), np.zeros(SYMBOLS**3, np.int64)
    for batch in slices(batches, "text"):
        data, offsets = text_bytes(batch.column("text"))
        flat = np.zeros(len(data) + len(offsets) + 1, np.int64)
        row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
        flat[np.arange(len(data)) + row + 1] = codes[data]
        flat = flat[(flat != 0) | np.append(True, flat[:-1] != 0)]
        if len(flat) > 2:
            total += np.bincount((flat[:-2] * SYMBOLS + flat[1:-1]) * SYMBOLS + flat[2:], minlength=SYMBOLS**3)
    some = np.flatnonzero(total)
    yield pa.record_batch({"trigram": some, "n": total[some]})


def character_model(docs: DataFrame, text_column: str = "text") -> np.ndarray:
    """log P(c | a, b) for the 28 symbols, from counts over all texts; smoothed by pairs and singles."""
    counts = np.zeros(SYMBOLS**3)
    for row in docs.select(whole_text(text_column).alias("text")).mapInArrow(
            count_trigrams, "trigram long, n long").groupBy("trigram").agg(F.sum("n").alias("n")).collect():
        counts[row.trigram] = row.n
    three = counts.reshape(SYMBOLS, SYMBOLS, SYMBOLS)
    two, one = three.sum(axis=0), three.sum(axis=(0, 1))
    single = (one + 1) / (one.sum() + SYMBOLS)
    pair = (two + 5 * single) / (two.sum(axis=1, keepdims=True) + 5)
    return np.log((three + 5 * pair[None]) / (three.sum(axis=2, keepdims=True) + 5))


class Restorer:
    """Best reading of a disguised stretch; readings are remembered up to a bound."""

    def __init__(self, model: np.ndarray) -> None:
        self.log = model.tolist()
        self.known: dict[str, str] = {}

    def __call__(self, token: str) -> str:
        if len(token) > KEPT_LENGTH:
            return self.decode(token)
        if token not in self.known:
            if len(self.known) >= KEPT_TOKENS:
                self.known.clear()
            self.known[token] = self.decode(token)
        return self.known[token]

    def lattice(self, token: str) -> list[list[tuple[str, float]]]:
        """For each place of the token its readings with their costs."""
        low = "".join(c for c in token.lower() if c not in ".-_~").strip(WHITE)
        letters = [i for i, c in enumerate(low) if c.isalpha()]
        places, at = [], 0
        while at < len(low):
            c, end = low[at], at
            while end < len(low) and low[end] == c:
                end += 1
            if c in WHITE:
                while end < len(low) and low[end] in WHITE:
                    end += 1
                places.append([("", 0.0), (" ", GAP if end - at == 1 else 0.0)])
                at = end
                continue
            same, size, further = end, end - at, end
            while c.isalpha() and further < len(low) and low[further] in WHITE + c:
                further += 1
                if low[further - 1] == c:
                    same, size = further, size + 1
            if size > 2:
                end = same
            inside = bool(letters) and letters[0] < at < letters[-1]
            if c.isalpha():
                places.append([(c * (end - at), 0.0)] if size < 3 else [(c, SQUEEZE), (2 * c, SQUEEZE)])
            elif c in LOOKS_LIKE and end - at < 3:
                cost = WILD if c == "*" else SUBSTITUTE
                for _ in range(end - at):
                    places.append([("", DROP_MARK if c in EDGE_MARKS and not inside else DROP_LETTERLIKE), *((x, cost) for x in LOOKS_LIKE[c])])
            else:
                places.append([("", 0.0)])
            at = end
        return places

    def decode(self, token: str) -> str:
        # Without any letter there is nothing to tell a word from a number.
        if not any(map(str.isalpha, token)):
            return token
        # Of each last two symbols only the best path goes on, as its last reading and the path before: linear in length.
        paths: dict[tuple[int, int], tuple[float, tuple]] = {(0, 0): (0.0, ())}
        for readings in self.lattice(token):
            following: dict[tuple[int, int], tuple[float, tuple]] = {}
            for (a, b), (score, path) in paths.items():
                for reading, cost in readings:
                    x, y, total = a, b, score + cost
                    for c in reading:
                        z = ord(c) - 96 if "a" <= c <= "z" else 0 if c == " " else 27
                        total += self.log[x][y][z]
                        x, y = y, z
                    found = following.get((x, y))
                    if found is None or total > found[0]:
                        following[x, y] = (total, (path, reading))
            paths = following
        best, path = -np.inf, ()
        for (a, b), (score, way) in paths.items():
            if score + self.log[a][b][0] > best:
                best, path = score + self.log[a][b][0], way
        out = []
        while path:
            path, reading = path
            out.append(reading)
        return "".join(reversed(out))


def disguised(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, start and end of each stretch that may hold disguised letters."""
    starts, ends, first = words(data, offsets)
    empty = np.zeros(0, np.int64)
    if not len(starts):
        return empty, empty, empty
    letter = np.zeros(256, bool)
    letter[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
    sign = np.zeros(256, bool)
    sign[[ord(c) for c in LOOKS_LIKE]] = True
    separator = np.zeros(256, bool)
    separator[[ord(c) for c in ".-_~*"]] = True
    is_letter, is_sign = letter[data], sign[data]
    beside = is_sign.copy()
    beside[1:-1] &= is_letter[:-2] | is_letter[2:]
    small = lowered(data)
    triple = np.zeros(len(data), bool)
    triple[:-2] = is_letter[:-2] & (small[:-2] == small[1:-1]) & (small[1:-1] == small[2:]) if len(data) > 2 else False
    parted = np.zeros(len(data), bool)
    if len(data) > 4:
        alone = is_letter[:-4] & separator[data][1:-3] & is_letter[2:-2] & separator[data][3:-1] & is_letter[4:]
        parted[:-4] = alone
    marked = np.add.reduceat((beside | triple | parted).astype(np.int64), starts) > 0
    marked &= np.add.reduceat(is_letter.astype(np.int64), starts) > 0
    row = np.searchsorted(first, np.arange(len(starts)), side="right") - 1
    # One sign, or a letter of two bytes, or a letter and a mark; not a word of two letters.
    ascii_letter = letter & (np.arange(256) < 128)
    single = (ends - starts == 2) & letter[data[starts]] & ~(ascii_letter[data[starts]] & letter[data[ends - 1]]) | (ends - starts == 1)
    same = np.append(False, single[1:] & single[:-1] & (row[1:] == row[:-1]))
    group = np.cumsum(~same)
    size = np.bincount(group)[group]
    spaced = single & (size >= SPACED_LETTERS)
    head = np.flatnonzero(spaced & ~same)
    tail = head + size[head] - 1
    other = np.flatnonzero(marked & ~spaced)
    return (np.concatenate([row[head], row[other]]), np.concatenate([starts[head], starts[other]]), np.concatenate([ends[tail], ends[other]]))


def readings(data: np.ndarray, offsets: np.ndarray, restorer: Restorer) -> Iterator[tuple[int, int, int, str]]:
    """Row, start, end and restored text of each stretch whose reading differs from it."""
    raw = data.tobytes()
    for row, start, end in zip(*(x.tolist() for x in disguised(data, offsets)), strict=True):
        token = raw[start:end].decode("utf-8", "replace")
        read = restorer(token)
        if read != token:
            yield row, start, end, read


def restore(docs: DataFrame, model: np.ndarray, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """id and restored text of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(model)
        for batch in slices(batches, "text"):
            data, offsets = text_bytes(batch.column("text"))
            raw = data.tobytes()
            parts: list[list[bytes]] = [[] for _ in range(batch.num_rows)]
            at = offsets[:-1].tolist()
            for row, start, end, read in sorted(readings(data, offsets, restorer)):
                parts[row] += [raw[at[row]: start], read.encode()]
                at[row] = end
            for row in range(batch.num_rows):
                parts[row].append(raw[at[row]: offsets[row + 1]])
            yield pa.record_batch({"id": batch.column("id"), "restored": pa.array([b"".join(x).decode("utf-8", "replace") for x in parts], pa.string())})

    id_type = docs.schema[id_column].dataType.simpleString()
    return docs.select(F.col(id_column).alias("id"), whole_text(text_column).alias("text")).mapInArrow(
        run, f"id {id_type}, restored string").withColumnRenamed("id", id_column)


def word_hashes(data: np.ndarray, offsets: np.ndarray, hashes: SpanHash, restorer: Restorer) -> tuple[np.ndarray, np.ndarray]:
    """Row of each word, as it stands and as restored, and the hashes of the word and of its stems.

    Words are runs of letters, lower-cased. A word without a stem of some length has 0 there.
    """
    letters = np.zeros(256, bool)
    letters[[*range(97, 123), *range(128, 256)]] = True
    found = []
    extra = list(readings(data, offsets, restorer))
    read = [x[3].encode() for x in extra]
    sets = [(lowered(data), offsets, np.arange(len(offsets) - 1))]
    if read:
        sets.append((lowered(np.frombuffer(b"".join(read), np.uint8)), np.cumsum([0, *map(len, read)]), np.array([x[0] for x in extra])))
    for text, places, owner in sets:
        starts, ends, first = words(np.where(letters[text], text, 32).astype(np.uint8), places)
        hashes.load(text)
        row = np.searchsorted(first, np.arange(len(starts)), side="right") - 1
        kinds = [hashes.spans(starts, ends)]
        for k, size in enumerate(STEMS):
            has = ends - starts >= size
            stem = np.zeros(len(starts), np.uint64)
            stem[has] = mixed(hashes.spans(starts[has], starts[has] + size) + np.uint64(k + 1))
            kinds.append(stem)
        found.append((owner[row], np.stack(kinds, axis=1)))
    return np.concatenate([x[0] for x in found]), np.concatenate([x[1] for x in found])


def rated_words(data: np.ndarray, offsets: np.ndarray, hashes: SpanHash, restorer: Restorer, known: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of the words and stems of each row, once for each rate they exceed; sorted, distinct.

    With `known` (sorted), only those hashes of words and stems are looked at.
    """
    row, word = word_hashes(data, offsets, hashes, restorer)
    total = np.bincount(row[word[:, 0] != 0], minlength=len(offsets) - 1)
    row = np.repeat(row, word.shape[1])
    word = word.reshape(-1)
    keep = word != 0
    if known is not None:
        keep &= known[np.minimum(np.searchsorted(known, word), len(known) - 1)] == word if len(known) else False
    row, word = row[keep], word[keep]
    order = np.lexsort((word, row))
    row, word = row[order], word[order]
    first = np.flatnonzero(np.append(True, (row[1:] != row[:-1]) | (word[1:] != word[:-1]))) if len(row) else row
    count = np.diff(np.append(first, len(row)))
    row, word = row[first], word[first]
    share = count / np.maximum(total[row], 1)
    rows, rated = [], []
    for level, rate in enumerate(RATES):
        over = share > rate
        rows.append(row[over])
        rated.append(mixed(word[over] + np.uint64(level)))
    return np.concatenate(rows), np.concatenate(rated)


def list_words(model: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """id, toxic and hash of the rated words of labelled rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, restorer = SpanHash(), Restorer(model)
        for batch in slices(batches, "text", 1 << 19):
            row, word = rated_words(*text_bytes(batch.column("text")), hashes, restorer)
            take = pa.array(row)
            yield pa.record_batch({
                "id": batch.column("id").take(take), "toxic": batch.column("toxic").take(take),
                "word": pa.array(word.view(np.int64))})

    return run


def evidence(toxic: np.ndarray, clean: np.ndarray, toxics: int, cleans: int) -> np.ndarray:
    """G-squared of words met in so many toxic and clean documents; 0 where they speak for clean."""
    total = max(toxics + cleans, 1)
    both = toxic + clean
    out = np.zeros(len(toxic))
    for seen, size in ((toxic, toxics), (clean, cleans)):
        for part, share in ((seen, both / total), (size - seen, 1 - both / total)):
            expected = np.maximum(size * share, 1e-9)
            out += 2 * np.where(part > 0, part * np.log(np.maximum(part, 1e-9) / expected), 0)
    return np.where(toxic * max(cleans, 1) > clean * max(toxics, 1), out, 0)


def fit(labelled: DataFrame, model: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Words, their weights and the offset of a logistic model, from rows (id, toxic, text), at most 2,000 of each label.

    Words are chosen one by one: the one with most evidence among the documents that hold fewer than
    three of those chosen before. So words that only go along with telling ones, as in copies, are
    not chosen; nor are words met in nearly the same documents as a chosen one. The weights are those of a logistic regression with a small ridge.
    """
    sizes = {bool(r.toxic): r.n for r in labelled.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    toxics, cleans = sizes.get(True, 0), sizes.get(False, 0)
    if not toxics or not cleans:
        return np.zeros(0, np.uint64), np.zeros(0), float(np.log((toxics + 0.5) / (cleans + 0.5)))
    seen = labelled.select("id", "toxic", "text").mapInArrow(list_words(model), "id long, toxic boolean, word long")
    seen = written(seen, "labelled-words")
    counts = seen.groupBy("word").agg(
        F.count(F.when(F.col("toxic"), 1)).alias("t"), F.count(F.when(~F.col("toxic"), 1)).alias("c"),
    ).where((F.col("t") >= FEWEST_DOCUMENTS) & (F.col("t") * cleans > 2 * F.col("c") * toxics))
    # Words of four toxic documents or more among at most 2,000: as many as have evidence, bounded by the labelled rows.
    table_ = counts.orderBy("word").toArrow()
    t, c = (table_.column(x).to_numpy() for x in ("t", "c"))
    candidates = table_.column("word").to_numpy()[evidence(t, c, toxics, cleans) >= LEAST_EVIDENCE]
    if not len(candidates):
        return np.zeros(0, np.uint64), np.zeros(0), float(np.log((toxics + 0.5) / (cleans + 0.5)))
    wanted = seen.sparkSession.createDataFrame([(x,) for x in candidates.tolist()], "word long")
    hits = seen.join(F.broadcast(wanted), "word").select("id", "toxic", "word").distinct().toArrow()
    own, who = np.unique(hits.column("id").to_numpy(), return_inverse=True)
    holds = np.zeros((len(own), len(candidates)), bool)
    holds[who, np.searchsorted(candidates, hits.column("word").to_numpy())] = True
    label = np.zeros(len(own), bool)
    label[who] = hits.column("toxic").to_numpy()
    chosen: list[int] = []
    covered, alike = np.zeros(len(own), np.int64), np.zeros(len(candidates), bool)
    held = holds.astype(np.float32)
    while len(chosen) < len(candidates):
        open_ = covered < COVER
        t, c = (open_ & label).astype(np.float32) @ held, (open_ & ~label).astype(np.float32) @ held
        gain = np.where((t >= FEWEST_DOCUMENTS) & (t > 2 * c), evidence(
            t, c, toxics - int((label & ~open_).sum()), cleans - int((~label & ~open_).sum())), 0)
        gain[alike] = 0
        best = int(np.argmax(gain))
        if gain[best] < LEAST_EVIDENCE:
            break
        both = held[:, best] @ held
        alike |= both >= ALIKE * (holds.sum(axis=0) + holds[:, best].sum() - both)
        chosen.append(best)
        covered += holds[:, best]
    # Rows without any candidate count through two rows of zeros.
    x = np.zeros((len(own) + 2, len(chosen) + 1))
    x[:-2, :-1] = holds[:, chosen]
    x[:, -1] = 1
    y = np.append(label, [True, False]).astype(float)
    n = np.append(np.ones(len(own)), [toxics - label.sum(), cleans - (~label).sum()])
    ridge = np.append(np.full(len(chosen), RIDGE), 1e-3)
    beta = np.zeros(len(chosen) + 1)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        hessian = (x * (n * p * (1 - p))[:, None]).T @ x + np.diag(ridge)
        step = np.linalg.solve(hessian, x.T @ (n * (y - p)) - ridge * beta)
        beta += np.clip(step, -1, 1)
        if np.abs(step).max() < 1e-8:
            break
    return candidates[chosen].view(np.uint64), beta[:-1], float(beta[-1])


def toxicity(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", folds: int = 5, held: int = 0) -> DataFrame:
    """One row per input row: id, held_out, score, predicted.

    Labels are learned from rows outside the held fold only, from at most 2,000 rows of each label,
    those with the least hash of their id; the character model is counted over all texts, without
    labels. The score looks at the text only. A null text counts as empty and gets the score of a
    text without telling words. An id with several labels counts as toxic if one says so; null labels and ids are left out.
    """
    model = character_model(docs, text_column)
    marks = (
        labels.where("doc_id is not null and toxic is not null").where(fold_of("doc_id", folds) != held)
        .groupBy(F.col("doc_id").alias("label_id")).agg((F.max("toxic") > 0).alias("toxic"))
        .withColumn("order", F.xxhash64("label_id"))
    )
    texts = docs.select(F.col(id_column).alias("id"), whole_text(text_column).alias("text"))
    taken = marks.where("toxic").orderBy("order", "label_id").limit(LABELLED_ROWS).unionByName(
        marks.where("not toxic").orderBy("order", "label_id").limit(LABELLED_ROWS))
    # At most 8,000 rows of two numbers, so safe to send to every task.
    sample = texts.join(F.broadcast(taken.select("label_id", "toxic")), F.col("id") == F.col("label_id"))
    chosen, weights, offset = fit(sample.select(F.col("id").cast("long").alias("id"), "toxic", "text"), model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, restorer = SpanHash(), Restorer(model)
        order = np.argsort(chosen)
        ordered, value = chosen[order], weights[order]
        plain = np.unique(np.concatenate([unmixed(ordered) - np.uint64(k) for k in range(len(RATES))]))
        for batch in slices(batches, "text", 1 << 20):
            total = np.zeros(batch.num_rows)
            if len(ordered):
                row, word = rated_words(*text_bytes(batch.column("text")), hashes, restorer, plain)
                at = np.minimum(np.searchsorted(ordered, word), len(ordered) - 1)
                hit = ordered[at] == word
                pairs = np.unique(row[hit] * len(ordered) + at[hit])
                total = np.bincount(pairs // len(ordered), value[pairs % len(ordered)], batch.num_rows)
            score = 1 / (1 + np.exp(-np.clip(total + offset, -30, 30)))
            yield pa.record_batch({"id": batch.column("id"), "score": pa.array(score)})

    id_type = docs.schema[id_column].dataType.simpleString()
    return texts.mapInArrow(run, f"id {id_type}, score double").select(
        F.col("id").alias(id_column), (fold_of("id", folds) == held).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"))
