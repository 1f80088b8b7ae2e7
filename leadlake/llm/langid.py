"""Language identification by unigram pieces, marginalised over all segmentations.

A language is a distribution over the pieces of a fixed public vocabulary. The
probability of a word (a run of letters, lower-cased, behind a word mark) is the
sum over all ways to cut it into pieces, found by a forward pass; a text's log
probability is the sum over its words, and the language with the largest one is
predicted. The piece probabilities come from expectation-maximisation over word
counts of labelled documents, whose E step (a forward and a backward pass per
distinct word) runs as a Spark job over (language, word) rows.

The fit takes the ``rows_per_lang`` labelled rows of each language (or all, if fewer)
that come first by a hash of id and text: a documented bound on a classifier's sample.
Rows without an id or with a repeated one are told apart by their texts, and of equal
rows as many are taken as are needed, counted rather than read again. The fit learns
from all their words, however long, and of up to 256 languages; more are an error,
as none may be left out unsaid. Scoring covers every whole text. Words and their scores
are cached within a task; cache and batches are sized by a budget of bytes.

Defined results: a null text, or one without letters, gives ``und`` and score 0;
so does everything if no row is labelled; equal log probabilities go to the
alphabetically first language; repeated rows repeat their result. The score is
the posterior of the prediction under equal priors.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import ahocorasick
import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leadlake.llm.common import id_text, in_fold, map_texts, ship_code, whole_text, written

VOCABULARY = public_tokenizers.path("piece_bpe_32k.model")
MARK = "▁"
UNDETERMINED = "und"
_WORDS = re.compile(r"[^\W\d_]+")
_UNKNOWN = 1e-7  # of a letter that no piece covers
_SCALE = math.log(1e100)


def words_of(text: str | None) -> list[str]:
    return _WORDS.findall(text.lower()) if text else []


def read_vocabulary(path: str = VOCABULARY) -> list[str]:
    """The vocabulary's pieces of letters, with or without the word mark."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = {model.id_to_piece(i) for i in range(model.get_piece_size())}
    return sorted(p for p in pieces if p == MARK or re.fullmatch(rf"{MARK}?[^\W\d_]+", p) and p == p.lower())


class Model:
    """Piece probabilities: piece -> one probability per language."""

    def __init__(self, langs: list[str], pieces: dict[str, tuple[float, ...]]):
        self.langs, self.pieces = langs, pieces
        self.longest = max(map(len, pieces), default=1)
        self.unknown = (_UNKNOWN,) * len(langs)

    def arcs(self, word: str) -> list[tuple[int, int, str, tuple[float, ...]]]:
        """(start, end, piece, probabilities) of all pieces in the marked word, by end; single letters always."""
        s, get, found = MARK + word, self.pieces.get, []
        for end in range(1, len(s) + 1):
            for start in range(max(0, end - self.longest), end):
                p = get(s[start:end])
                if p is None and end - start == 1:
                    p = self.unknown
                if p is not None:
                    found.append((start, end, s[start:end], p))
        return found

    def log_probabilities(self, word: str) -> list[float]:
        """Per language, the log of the summed probability of all segmentations of the word.

        The forward sums are scaled up whenever they get small, so long words don't underflow."""
        n, out, arcs = len(word) + 1, [], self.arcs(word)
        for k in range(len(self.langs)):
            sums, at, log_scale = [1.0] + [0.0] * n, 0, 0.0
            for start, end, _, p in arcs:
                if end != at:
                    if sums[at] < 1e-100:
                        for i in range(max(0, at - self.longest), at + 1):
                            sums[i] *= 1e100
                        log_scale -= _SCALE
                    at = end
                sums[end] += sums[start] * p[k]
            out.append(math.log(max(sums[n], 1e-300)) + log_scale)
        return out

    def expected_pieces(self, word: str, k: int) -> dict[str, float]:
        """Expected number of each piece in a segmentation of the word, in language ``k``.

        Both passes are scaled up like those of ``log_probabilities``; ``ups`` and ``downs`` say how often a sum was."""
        n, arcs, found = len(word) + 1, self.arcs(word), {}
        ahead, behind = [1.0] + [0.0] * n, [0.0] * n + [1.0]
        ups, downs, at, times = [0] * (n + 1), [0] * (n + 1), 0, 0
        for start, end, _, p in arcs:
            if end != at:
                if ahead[at] < 1e-100:
                    times += 1
                    for i in range(max(0, at - self.longest), at + 1):
                        ahead[i] *= 1e100
                        ups[i] = times
                at, ups[end] = end, times
            ahead[end] += ahead[start] * p[k]
        at, times = n, 0
        for start, end, _, p in sorted(arcs, key=lambda a: -a[0]):
            if start != at:
                if behind[at] < 1e-100:
                    times += 1
                    for i in range(at, min(n, at + self.longest) + 1):
                        behind[i] *= 1e100
                        downs[i] = times
                at, downs[start] = start, times
            behind[start] += p[k] * behind[end]
        for start, end, piece, p in arcs:
            if lift := ups[n] - ups[start] - downs[end]:
                e = math.exp(math.log(ahead[start]) + math.log(p[k]) + math.log(behind[end]) - math.log(ahead[n]) + lift * _SCALE)
            else:
                e = ahead[start] * p[k] * behind[end] / ahead[n]
            found[piece] = found.get(piece, 0.0) + e
        return found


def training_words(docs: DataFrame, rows_per_lang: int, id_col: str, text_col: str, lang_col: str,
                   most_langs: int = 256, from_all: bool = False) -> DataFrame:
    """(lang, word, n) over the sample of ``rows_per_lang`` labelled rows per language."""
    learnt_from = F.lit(True) if from_all else ~in_fold(id_col, 4, 2)
    labelled = docs.where(F.col(lang_col).isNotNull() & learnt_from).select(
        F.col(lang_col).alias("lang"), F.xxhash64(F.lit("langid"), id_text(id_col), whole_text(text_col)).alias("draw"),
        F.col(text_col).alias("_text"))
    # The limit works within each task before anything is shuffled; what is left is a row per sampled row at most.
    first = Window.partitionBy("lang").orderBy("draw")
    taken = (labelled.select("lang", "draw", F.row_number().over(first).alias("_n")).where(F.col("_n") <= rows_per_lang)
             .groupBy("lang", "draw").agg(F.count(F.lit(1)).alias("times")))
    taken = written(taken, "langid-sample")
    if taken.select("lang").distinct().limit(most_langs + 1).count() > most_langs:
        raise ValueError(f"more than {most_langs} languages are labelled")
    # At most rows_per_lang x most_langs rows. Equal rows are one, counted as often as they were taken.
    rows = (labelled.join(F.broadcast(taken), ["lang", "draw"]).groupBy("lang", "draw")
            .agg(F.first("_text").alias("_text"), F.first("times").alias("times")))

    def count():
        return lambda texts: [[(w, c) for w, c in Counter(words_of(t)).items()] for t in texts]

    return (map_texts(rows, count, {"word": "string", "n": "long"}, many=True)
            .groupBy("lang", "word").agg(F.sum(F.col("n") * F.col("times")).alias("n")))


def fit(docs: DataFrame, vocabulary: str = VOCABULARY, rows_per_lang: int = 200, rounds: int = 2,
        smoothing: float = 0.1, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        from_all: bool = False) -> Model:
    """Piece probabilities of every labelled language; ``from_all`` learns from held-out rows, too.

    What reaches the driver is bounded by languages x vocabulary."""
    vocab = read_vocabulary(vocabulary)
    ship_code(docs.sparkSession)
    words = written(training_words(docs, rows_per_lang, id_col, text_col, lang_col, from_all=from_all), "langid-words")
    langs = sorted(r["lang"] for r in words.select("lang").distinct().collect())
    model = Model(langs, dict.fromkeys(vocab, (1.0 / len(vocab),) * len(langs)))
    known, place = set(vocab), {lang: k for k, lang in enumerate(langs)}
    if not langs:
        return model
    row = {p: k for k, p in enumerate(vocab)}
    for _ in range(rounds):
        def expect(batches, model=model):
            sums: Counter = Counter()  # at most languages x vocabulary
            for batch in batches:
                for lang, word, n in zip(*(batch.column(c).to_pylist() for c in ("lang", "word", "n"))):
                    for piece, e in model.expected_pieces(word, place[lang]).items():
                        if piece in known:
                            sums[place[lang], row[piece]] += e * n
            keys = sorted(sums)
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in keys], pa.int32()), pa.array([k[1] for k in keys], pa.int32()),
                 pa.array([sums[k] for k in keys], pa.float64())], ["lang", "piece", "e"])

        got = (words.repartition(words.sparkSession.sparkContext.defaultParallelism)
               .mapInArrow(expect, "lang int, piece int, e double")
               .groupBy("lang", "piece").agg(F.sum("e").alias("e")).toPandas())
        counts = np.full((len(langs), len(vocab)), smoothing)
        counts[got["lang"].to_numpy(), got["piece"].to_numpy()] += got["e"].to_numpy()
        counts /= counts.sum(axis=1, keepdims=True)
        model = Model(langs, {p: tuple(x) for p, x in zip(vocab, counts.T.tolist())})
    return model


class Scorer:
    """Predictions for texts; word scores are kept up to a bound."""

    def __init__(self, model: Model, cache_bytes: int = 64 << 20, batch_bytes: int = 32 << 20, short: int = 40):
        word = 8 * max(1, len(model.langs))  # bytes of a word's scores
        self.model, self.most, self.short = model, max(1000, min(250_000, cache_bytes // word)), short
        self.step = max(1000, min(100_000, batch_bytes // word))
        self.at_once = max(16, min(4096, batch_bytes // (word * (short + 2))))
        self.place: dict[str, int] = {}
        self.table = np.zeros((1024, max(1, len(model.langs))))
        self.chances = np.array([*model.pieces.values(), model.unknown]).reshape(len(model.pieces) + 1, -1)
        self.finder = ahocorasick.Automaton()  # every place of every piece, in one pass
        for k, piece in enumerate(model.pieces):
            self.finder.add_word(piece, k << 8 | len(piece))
        self.finder.make_automaton()
        letters = "".join(re.escape(p) for p in model.pieces if len(p) == 1)
        self.uncovered = re.compile(f"[^{letters}]" if letters else "(?s).")

    def scores(self, words: list[str]) -> np.ndarray:
        """Log probabilities of words of up to ``short`` letters, a row each: the forward pass of all at once.

        Scaling isn't needed at these lengths."""
        joined = MARK + MARK.join(words)  # no piece holds a mark but in front, so none spans two words
        first_at = np.cumsum([0, *(len(w) + 1 for w in words[:-1])])
        found = list(self.finder.iter(joined)) if len(self.chances) > 1 else []
        alone = [(m.start(), (len(self.chances) - 1) << 8 | 1) for m in self.uncovered.finditer(joined)]
        found = np.array(found + alone, np.int64)
        found = found[np.argsort(found[:, 0], kind="stable")]
        at = np.searchsorted(first_at, found[:, 0], side="right") - 1
        ends = found[:, 0] - first_at[at] + 1
        pieces, starts = found[:, 1] >> 8, ends - (found[:, 1] & 255)
        order = np.argsort(ends, kind="stable")  # by end, then word
        at, starts, chances = at[order], starts[order], self.chances[pieces[order]]
        widest = int(ends.max())
        sums = np.zeros((len(words), widest + 1, self.chances.shape[1]))
        sums[:, 0] = 1.0
        bounds = np.searchsorted(ends[order], np.arange(1, widest + 2))
        for end in range(1, widest + 1):
            part = slice(bounds[end - 1], bounds[end])
            own = at[part]
            first = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
            sums[own[first], end] = np.add.reduceat(sums[own, starts[part]] * chances[part], first, axis=0)
        return np.log(np.maximum(sums[np.arange(len(words)), [len(w) + 1 for w in words]], 1e-300))

    def _learn(self, words: set[str]) -> None:
        new = [w for w in words if len(w) <= self.short]
        logs = [self.scores(new[k:k + self.at_once]) for k in range(0, len(new), self.at_once)]
        for w in words:
            if len(w) > self.short:
                new.append(w)
                logs.append(np.array([self.model.log_probabilities(w)]))
        first = len(self.place)
        if first + len(new) > len(self.table):
            grown = np.zeros((max(2 * len(self.table), first + len(new)), self.table.shape[1]))
            grown[:first] = self.table[:first]
            self.table = grown
        self.table[first:first + len(new)] = np.concatenate(logs)
        self.place.update(zip(new, range(first, first + len(new))))

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        langs, split = self.model.langs, [words_of(t) for t in texts]
        if not langs:
            return [(UNDETERMINED, 0.0) for _ in texts]
        out = []
        if len(self.place) > self.most:
            self.place.clear()
        if new := set().union(*split).difference(self.place):
            self._learn(new)
        place = self.place.__getitem__
        for words in split:
            if not words:
                out.append((UNDETERMINED, 0.0))
                continue
            logs = np.zeros(len(langs))
            for k in range(0, len(words), self.step):  # bounds the memory of a very long text
                part = words[k:k + self.step]
                logs += self.table[np.fromiter(map(place, part), np.int64, len(part))].sum(axis=0)
            best = int(logs.argmax())
            out.append((langs[best], float(1.0 / np.exp(np.minimum(logs - logs[best], 0.0)).sum())))
        return out


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
             carry: list[str] | None = None) -> DataFrame:
    """doc_id (or the ``carry`` columns), lang_pred and score for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by languages x vocabulary

    def scorer():
        return Scorer(shared.value).predict

    keep = [F.col(f"`{c}`") for c in carry or [id_col]]
    return map_texts(docs.select(*keep, F.col(text_col).alias("_text")), scorer,
                     {"lang_pred": "string", "score": "double"})


def language_id(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                **fit_options) -> DataFrame:
    """doc_id, held_out, lang_pred and score for every row; learns only from rows that aren't held out."""
    model = fit(docs, id_col=id_col, text_col=text_col, lang_col=lang_col, **fit_options)
    return identify(docs, model, id_col, text_col).withColumn("held_out", in_fold(id_col, 4, 2))


def keep_identified(docs: DataFrame, least_score: float = 0.5, text_col: str = "text", lang_col: str = "lang",
                    id_col: str = "doc_id", **fit_options) -> DataFrame:
    """The rows whose language can be told: not ``und``, and a posterior of ``least_score`` or more.

    Where all labelled rows are held out (they share an id), it learns from them all the same: a filter has no test part."""
    model = fit(docs, id_col=id_col, text_col=text_col, lang_col=lang_col, **fit_options)
    if not model.langs:
        model = fit(docs, id_col=id_col, text_col=text_col, lang_col=lang_col, from_all=True, **fit_options)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    found = identify(docs.select(row.alias("_row"), F.col(text_col)), model, text_col=text_col, carry=["_row"])
    found = found.where((F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= least_score))
    return found.select(*[F.col("_row").getField(c).alias(c) for c in docs.columns])
