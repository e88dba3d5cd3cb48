"""Toxicity by a weighted finite-state pattern grammar.

Words are mapped to the grammar's symbols: insult, threat, target, negation, reported speech,
clause end, other. One small transducer follows each of target, negation and insult, reported speech
and threat through a clause; their composition is one table, run once over a clause. Arcs that read
an insult write it, with its weight, as open or as denied, by the negations just before it; the state
at the clause's end says what the written weights count for: plain, at a target, denied or
reported. A document's score is a logistic function of its matched clauses by kind.

Insults are learned as words and as word beginnings (stems of inflected forms) from labelled
documents: by how often they are used, damped in each document, in toxic and in clean ones. Copies
share the weight of one document, or the words of a much copied document would all look toxic.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from blotterline.llm.common import bound_batches, crc32_of, map_frames, materialize, small_frames
from blotterline.llm.models import bounded_sample, fit_logistic, logistic

#: Labelled documents per class that the grammar is fitted on (chosen by a hash of doc_id).
SAMPLE_PER_CLASS = 8_000
#: Documents that an insult must be in, and by how much likelier it is in toxic ones (log odds).
LEAST_SUPPORT, LEAST_ODDS = 8, 3.0
STEMS = (4, 5, 6, 7, 8)
#: Documents with one label that share so many minhashes of three-word shingles are copies.
MINHASHES = 6
FRAME_CHARS = 1_000_000

OTHER, TARGET, NEGATION, REPORT, THREAT, INSULT, END = range(7)

# English words of the closed classes. Insults are learned.
TARGETS = frozenset("you your yours yourself u ur he she they them him her his their we us these those people".split())
NEGATIONS = frozenset("not no never none neither nor cannot isnt arent wasnt werent dont doesnt didnt wont without".split())
REPORTS = frozenset("said says say told tells wrote writes claimed claims quoted quotes called reported reports according".split())
THREATS = frozenset("kill kills killing murder hurt hurting destroy attack stab shoot strangle punish beat smash".split())

TOKEN = re.compile(r"[^\W_]+|[.!?;:\n]")
WORD = re.compile(r"[^\W_]+")
CLAUSE = re.compile(r"[.!?;:\n]+")
KINDS = ("plain", "targeted", "denied", "reported", "threat")
FACTORS = np.array([1.0, 1.5, 0.2, 0.4, 1.5])


SYMBOL_COUNT = 7
#: What an arc writes: nothing, or the weight of the insult that it reads.
NOTHING, OPEN, DENIED = range(3)


class Transducer:
    """States 0 .. n-1 from 0; ``table[state][symbol]`` is the next state, ``output`` what is written."""

    def __init__(self, table: list[list[int]], output: list[list[int]] | None = None):
        self.table = table
        self.output = output or [[NOTHING] * SYMBOL_COUNT for _ in table]

    def compose(self, other: Transducer) -> Transducer:
        """Both at once: states are pairs, numbered row by row; one of the two writes."""
        wide = len(other.table)
        pairs = list(product(range(len(self.table)), range(wide)))
        every = range(SYMBOL_COUNT)
        return Transducer(
            [[self.table[a][s] * wide + other.table[b][s] for s in every] for a, b in pairs],
            [[self.output[a][s] or other.output[b][s] for s in every] for a, b in pairs],
        )


def _seen(symbol: int) -> Transducer:
    """Whether the symbol has been seen in the clause."""
    rows = []
    for state in range(2):
        row = [state] * SYMBOL_COUNT
        row[symbol], row[END] = 1, 0
        rows.append(row)
    return Transducer(rows)


#: Words after a negation that it still denies.
REACH = 3


def _insults() -> Transducer:
    """States: how far a negation still reaches, and whether an insult has been read (from
    ``REACH + 1`` on). An insult is written as denied where a negation reaches it."""
    rows, output = [], []
    for read in (0, 1):
        for reach in range(REACH + 1):
            base = read * (REACH + 1)
            row = [base + max(0, reach - 1)] * SYMBOL_COUNT
            row[NEGATION], row[INSULT], row[END] = base + REACH, REACH + 1 + max(0, reach - 1), 0
            rows.append(row)
            written = [NOTHING] * SYMBOL_COUNT
            written[INSULT] = DENIED if reach else OPEN
            output.append(written)
    return Transducer(rows, output)


GRAMMAR = _seen(TARGET).compose(_seen(REPORT)).compose(_seen(THREAT)).compose(_insults())


def clause_kinds(state: int) -> tuple[int, int, int | None]:
    """Of a clause that ends in a state of the grammar: the kind of its open and of its denied
    insults, and the kind of its threat (None: it has none, or insults speak for it)."""
    state, insult = divmod(state, 2 * (REACH + 1))
    state, threat = divmod(state, 2)
    target, report = divmod(state, 2)
    threatens = threat and target and insult <= REACH
    if report:
        return 3, 3, 3 if threatens else None
    return (1 if target else 0), 2, 4 if threatens else None


FINAL = [clause_kinds(state) for state in range(len(GRAMMAR.table))]
SYMBOLS = {
    **dict.fromkeys(TARGETS, TARGET),
    **dict.fromkeys(NEGATIONS, NEGATION),
    **dict.fromkeys(REPORTS, REPORT),
    **dict.fromkeys(THREATS, THREAT),
}


class ToxicGrammar:
    """Learned insults with weights, and the weights of clause kinds."""

    def __init__(self, words: dict[str, float], stems: dict[str, float]):
        self.words, self.stems = words, stems
        self.weights = np.zeros(len(KINDS) + 3)

    def insult(self, word: str) -> float:
        """The weight of a word as an insult; 0: none."""
        weight = self.words.get(word, 0.0)
        for size in STEMS:
            if len(word) >= size:
                weight = max(weight, self.stems.get(word[:size], 0.0))
        return weight

    def features(self, texts: list[str]) -> np.ndarray:
        """Damped sums of weights, per kind of clause and over all by the kinds' own factors (so
        that a kind that training lacks still counts); the damped number of insults used."""
        x = np.zeros((len(texts), len(KINDS) + 2))
        for at, text in enumerate(texts):
            text = text.lower().replace("'", "")
            words = WORD.findall(text)
            weights = {w: i for w in set(words) if (i := self.insult(w))}
            if not weights and THREATS.isdisjoint(words):
                continue
            sums = np.zeros(len(KINDS))
            for clause in CLAUSE.split(text):
                state, written = 0, [0.0, 0.0, 0.0]
                for word in WORD.findall(clause):
                    own = weights.get(word)
                    symbol = INSULT if own else SYMBOLS.get(word, OTHER)
                    written[GRAMMAR.output[state][symbol]] += own or 0.0
                    state = GRAMMAR.table[state][symbol]
                open_kind, denied_kind, threat_kind = FINAL[state]
                sums[open_kind] += written[OPEN]
                sums[denied_kind] += written[DENIED]
                if threat_kind is not None:
                    sums[threat_kind] += 1.0
            x[at, : len(KINDS)] = np.log1p(sums)
            x[at, -2:] = math.log1p(float(sums @ FACTORS)), math.log1p(len(weights))
        return x

    def scores(self, texts: list[str]) -> np.ndarray:
        return logistic(self.features(texts), self.weights)


def _signature(words: list[str]) -> str:
    """The least of several hashes of the text's three-word shingles: copies have all in common."""
    shingles = {" ".join(words[i : i + 3]).encode() for i in range(max(1, len(words) - 2))}
    own = np.array([xxh64_intdigest(s) for s in shingles], np.uint64)
    seeds = np.random.default_rng(3).integers(1, 1 << 62, MINHASHES, np.uint64) | np.uint64(1)
    return ",".join(f"{int((own * seed).min()):x}" for seed in seeds)


def fit_grammar(docs: DataFrame, labels: DataFrame) -> ToxicGrammar:
    """The grammar from ``labels`` (doc_id, toxic 0 or 1) and the texts they belong to.

    At most ``SAMPLE_PER_CLASS`` documents of each class, whole texts; a repeated doc_id counts
    once, and the copies of a text share the weight of one. Null labels and labels without a document are left out. Without
    documents of both classes every score is the share of toxic labels (none: 0).
    """
    spark = docs.sparkSession
    bound_batches(spark)
    known = labels.where(F.col("toxic").isin(0, 1)).select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    share = known.agg(F.avg("toxic")).first()[0] or 0.0
    chosen = bounded_sample(known, SAMPLE_PER_CLASS, "toxic")
    texts = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    # Two classes of SAMPLE_PER_CLASS ids, so both the broadcast and the sample are bounded.
    sample = materialize(
        texts.join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id", "toxic"]), "toxic-sample"
    )
    kind = docs.schema["doc_id"].dataType.simpleString()

    def signed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield frame.assign(signature=[_signature(t.lower().split()) for t in frame["text"]])

    schema = sample.select("*", F.lit("").alias("signature")).schema
    signatures = materialize(map_frames(sample, signed, schema), "toxic-signed")
    copies = signatures.groupBy("toxic", "signature").agg((1 / F.count(F.lit(1))).alias("weight"))
    sample = materialize(signatures.join(copies, ["toxic", "signature"]).drop("signature"), "toxic-weighted")

    def parts(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Words and stems: documents that have them, and their damped uses, over the task's documents."""
        found: dict[tuple[str, bool], np.ndarray] = defaultdict(lambda: np.zeros(3))
        for frame in frames:
            for text, toxic, weight in zip(frame["text"], frame["toxic"], frame["weight"], strict=True):
                used = Counter(WORD.findall(text.lower().replace("'", "")))
                stems: Counter = Counter()
                for word, times in used.items():
                    for size in STEMS:
                        if len(word) > size:
                            stems[word[:size]] += times
                for is_stem, counts in ((False, used), (True, stems)):
                    for part, times in counts.items():
                        own = found[part, is_stem]
                        own[toxic] += weight * math.log2(1 + times)
                        own[2] += weight * toxic
        rows = [(part, stem, *own.tolist()) for (part, stem), own in found.items()]
        yield pd.DataFrame(rows, columns=["part", "stem", "clean", "toxic", "support"])

    found = (
        sample.mapInPandas(parts, "part string, stem boolean, clean double, toxic double, support double")
        .groupBy("part", "stem")
        .agg(*[F.sum(name).alias(name) for name in ("clean", "toxic", "support")])
        # Sums of weights differ in the last digits with their order.
        .where(F.col("support") >= LEAST_SUPPORT - 1e-6)
        .toPandas()
    )
    sizes = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.sum("weight").alias("n")).collect()}
    if len(sizes) < 2:
        grammar = ToxicGrammar({}, {})
        grammar.weights[-1] = math.log(max(share, 1e-9) / max(1 - share, 1e-9))
        return grammar
    odds = np.log((found["toxic"] + 0.5) / (sizes[1] + 1)) - np.log((found["clean"] + 0.5) / (sizes[0] + 1))
    found = found.assign(odds=odds)[odds >= LEAST_ODDS]
    words, stems = (
        dict(found.loc[found["stem"] == of, ["part", "odds"]].itertuples(index=False)) for of in (False, True)
    )
    grammar = ToxicGrammar(words, stems)

    def shape(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            own = list(grammar.features(frame["text"].tolist()))
            yield pd.DataFrame({"toxic": frame["toxic"], "weight": frame["weight"], "x": own})

    fitted = sample.select("toxic", "weight", "text").mapInPandas(shape, "toxic int, weight double, x array<double>").toPandas()
    y, weight = fitted["toxic"].to_numpy(float), fitted["weight"].to_numpy(float)
    grammar.weights = fit_logistic(np.array(fitted["x"].tolist()), y, sample_weights=weight)
    own = (y * weight).sum() / ((1 - y) * weight).sum()
    grammar.weights[-1] += math.log(share / (1 - share) / own)
    return grammar


def with_toxicity(docs: DataFrame, grammar: ToxicGrammar, text: str = "text") -> DataFrame:
    """``docs`` with ``toxicity`` (0 to 1); a column so named is replaced.

    Null and empty texts have the score of a text without a matched clause. Rows are scored one
    by one: no shuffle, repeated rows stay, an empty table gives no rows.
    """
    bound_batches(docs.sparkSession)
    docs = docs.drop("toxicity")
    shared = docs.sparkSession.sparkContext.broadcast(grammar)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in small_frames(frames, text, FRAME_CHARS):
            yield frame.assign(toxicity=shared.value.scores(frame[text].fillna("").tolist()))

    return map_frames(docs, run, docs.select("*", F.lit(0.0).alias("toxicity")).schema)


def held_out(doc_id: str = "doc_id"):
    """Rows whose labels the registered query never learns from."""
    return crc32_of(F.col(doc_id)) % 5 == 0


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for ``documents``, learned from labels not held out."""
    grammar = fit_grammar(docs, labels.where(~held_out()))
    return with_toxicity(docs.select("doc_id", "text"), grammar).select(
        "doc_id",
        held_out().alias("held_out"),
        F.col("toxicity").alias("score"),
        (F.col("toxicity") >= 0.5).cast("int").alias("predicted"),
    )
