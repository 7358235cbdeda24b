"""Toxicity by a weighted finite-state pattern grammar.

A text is cut into clauses. Five transducers read a clause one after the other, each rewriting the symbols that the one
before wrote: the lexicon (words to insult, threat, target, negation, report or other, with a weight), then targets,
negation and reported speech, which only change the weight and the kind of a match (aimed, denied, quoted). A threat is
a symbol of the lexicon too: a verb of harm with a target, in a future form, after a future or modal verb, or right before
a second person; it passes through the same steps. So a clause, not a word alone, is scored: its value is the sum of its matches by kind, and a text's score is a logistic function of
the matches of all its clauses and of the strongest clause.

Function words and threat verbs are fixed lists in four languages. Other entries are learned: words, pairs of words next
to each other in a clause, and stems of a few letters with any ending, that are far more frequent in texts labelled toxic. Their weights and the logistic weights are fitted
on a bounded sample of labelled rows (``FIT_ROWS``, by hash of the id); every row is scored on its whole text.

Defined results: null and empty texts get the score of a text without matches; labels without a value, and labels of
unknown documents, teach nothing; several labels of one document count once each; repeated rows are scored alike;
without usable labels the fixed insults and threats alone count; empty table, no rows; other columns pass through ``score``.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.token_files import chunks

#: Labelled rows that the lexicon and the weights are fitted on, at most (about).
FIT_ROWS = 24_000
#: Learned entries at most: a bound on what the driver and the tasks hold.
LEXICON_MAX = 5_000
STEM_LENGTHS = (4, 5, 6)
MIN_DOCS, MIN_ODDS = 6, 4.0

TARGETS = frozenset(w.encode() for w in "you your you're yourself u he she they them du dich dir euch ihr sie tu te toi vous ton votre usted ustedes vosotros tú ti él ellos".split())
NEGATIONS = frozenset(w.encode() for w in "not no never isn't aren't don't won't wouldn't can't couldn't shouldn't didn't doesn't wasn't cannot nicht kein keine keinen nie pas jamais aucun ne nunca jamás ningún".split())
REPORTS = frozenset(w.encode() for w in "said says say told called calls wrote quoted quote according claimed sagte sagt nannte schrieb laut dit disait appelé selon dijo dice llamó según".split())
#: Fixed entries, for use without labels; learning adds to them.
INSULTS = ("idiot", "moron", "stupid", "scum", "worthless", "pathetic", "loser", "dumm", "idiota", "imbécile")
#: Future and modal verbs ("I'll" by its ending), and verbs of harm that need one, or that are in a future form themselves.
FUTURES = frozenset(w.encode() for w in "will would shall should gonna going must can could might werde wirst wird werden werdet würde wollen soll sollte muss kann könnte vais vas va allons allez vont veux veut dois doit peux peut voy vamos van vais quiero quiere debo debe puedo puede".split())
HARMS = frozenset(w.encode() for w in "kill hurt destroy murder shoot stab beat strangle smash töten umbringen verletzen erschießen erstechen schlagen verprügeln zerstören tuer blesser frapper détruire massacrer étrangler écraser matar herir golpear destruir asesinar disparar apuñalar".split())
FUTURE_HARMS = frozenset(w.encode() for w in "tuerai tuera tuerons tueront frapperai frappera détruirai détruira massacrerai blesserai écraserai étranglerai mataré matará mataremos matarán heriré golpearé golpeará destruiré destruirá asesinaré".split())
#: Objects of a threat besides ``TARGETS``; the clitics are articles elsewhere and count right before a verb only.
OBJECTS = TARGETS | frozenset(w.encode() for w in "him her us everyone ihn ihm ihnen uns alle eux elle nous os ella ellas nosotros todos".split())
CLITICS = frozenset(w.encode() for w in "te le la les los las lo os se lui leur vous".split())
SECOND = frozenset(w.encode() for w in "you u dich euch".split())
#: Forms that hold their object: "matarte", "t'écraser".
ATTACHED = frozenset(v + e.encode() for v in HARMS if v.endswith(("ar".encode(), "ir".encode())) for e in "te le lo la os les los las".split())
ELIDED = {e + v: v for e in (b"t'", b"l'") for v in HARMS | FUTURE_HARMS if v.decode()[0] in "aeiouyéêh"}
THREAT_WORDS = HARMS | FUTURE_HARMS | ATTACHED | ELIDED.keys()
#: As much as the weakest learned entry.
THREAT_WEIGHT = 4.0
#: How far the future or modal verb and the target can be from the verb of harm, in words.
THREAT_REACH = 5

CLAUSE = re.compile(rb"[.!?;:\n]+")
#: ASCII letters, apostrophes and all bytes of other letters stay; anything else separates words.
FLAT = bytes(b if b in b"abcdefghijklmnopqrstuvwxyz'" or b >= 128 else 32 for b in range(256))
KINDS = ("aimed", "bare", "denied", "quoted")
FEATURES = ("any", *KINDS, "strongest", "threat", "density")


@dataclass
class Grammar:
    """The composed transducers. ``words`` and ``stems`` map entries to weights."""

    words: dict[bytes, float] = field(default_factory=dict)
    stems: dict[bytes, float] = field(default_factory=dict)
    #: How far a negation or target reaches, in words.
    reach: int = 3
    pairs: dict[tuple[bytes, bytes], float] = field(default_factory=dict)

    def weight(self, word: bytes) -> float:
        """The lexicon transducer's weight of a word: its own entry, else that of its longest stem."""
        found = self.words.get(word)
        if found is None and self.stems:
            letters = word.decode("utf-8", "replace")
            found = next((w for n in reversed(STEM_LENGTHS) if (w := self.stems.get(letters[:n].encode())) is not None), None)
        return found or 0.0

    def symbols(self, words: list[bytes]) -> list[tuple[str, float]]:
        """First transducer: words to symbols."""
        out = []
        for word in words:
            if weight := self.weight(word):
                out.append(("match", weight))
            elif word in TARGETS:
                out.append(("target", 0.0))
            elif word in NEGATIONS:
                out.append(("not", 0.0))
            elif word in REPORTS:
                out.append(("report", 0.0))
            else:
                out.append(("", 0.0))
        if self.pairs:
            for i, pair in enumerate(zip(words, words[1:])):
                # On the word that is no function word, so that targets and negations stay; entries of their own go first.
                if (weight := self.pairs.get(pair)) and "match" not in (out[i][0], out[i + 1][0]):
                    at = next((j for j in (i, i + 1) if not out[j][0]), None)
                    if at is not None:
                        out[at] = ("match", weight)
        for i, word in enumerate(words):
            if word in THREAT_WORDS and self.threatens(words, i):
                out[i] = ("threat", max(THREAT_WEIGHT, out[i][1]))
        return out

    @staticmethod
    def threatens(words: list[bytes], i: int) -> bool:
        """Whether the verb of harm at ``i`` has a target, and a future of its own or near it."""
        verb = ELIDED.get(words[i], words[i])
        near = range(max(0, i - THREAT_REACH), min(len(words), i + THREAT_REACH + 1))
        futures = [j for j in near if words[j] in FUTURES or words[j].endswith(b"'ll")]
        if verb not in FUTURE_HARMS and not futures:
            return words[i + 1 : i + 2] != [] and words[i + 1] in SECOND
        if words[i] in ATTACHED or words[i] in ELIDED:
            return True
        # A subject before the verb is no target: objects stand after the verb, or between the future and the verb.
        between = range(min([j for j in futures if j < i], default=i) + 1, i)
        after = range(i + 1, min(len(words), i + 1 + 3))
        clitic = any(words[j - 1] in CLITICS for j in (i, *futures) if j > 0)
        before = any(words[j] in OBJECTS for j in (*between, *([i - 1, i - 2] if futures and futures[-1] > i else [])) if j >= 0)
        return clitic or before or any(words[j] in OBJECTS for j in after)

    def clause(self, words: list[bytes]) -> list[tuple[str, float]]:
        """The matches of a clause with their kinds, after all transducers."""
        return [(kind, weight) for kind, weight, _ in self.matches(words)]

    def matches(self, words: list[bytes]) -> list[tuple[str, float, bool]]:
        """``clause``, and whether the match is a threat."""
        read = self.symbols(words)
        state_report, since_not = False, self.reach + 1
        near = [i for i, (s, _) in enumerate(read) if s == "target"]
        out = []
        for i, (symbol, weight) in enumerate(read):
            since_not = 0 if symbol == "not" else since_not + 1
            state_report |= symbol == "report"
            if symbol in ("match", "threat"):
                if state_report:
                    kind = "quoted"
                elif since_not <= self.reach:
                    kind = "denied"
                else:
                    kind = "aimed" if symbol == "threat" or any(abs(i - j) <= self.reach for j in near) else "bare"
                out.append((kind, weight, symbol == "threat"))
        return out

    def matched(self, low: bytes) -> bool:
        """Whether any word of a text can match: most texts end here."""
        said = low.translate(FLAT).split()
        words = set(said)
        if not self.words.keys().isdisjoint(words) or not THREAT_WORDS.isdisjoint(words):
            return True
        if self.pairs and not self.pairs.keys().isdisjoint(zip(said, said[1:])):
            return True
        if not self.stems:
            return False
        # A stem of n letters has n to 4n bytes; compare whole letters.
        flat = {w.decode("utf-8", "replace") for w in words if len(w) >= STEM_LENGTHS[0]}
        return any(not self._text_stems.isdisjoint({w[:n] for w in flat}) for n in STEM_LENGTHS)

    def __post_init__(self):
        self._text_stems = {s.decode() for s in self.stems}

    def features(self, text: str | None) -> list[float]:
        """What the logistic function reads, in the order of ``FEATURES``."""
        out = dict.fromkeys(FEATURES, 0.0)
        low = (text or "").lower().encode("utf-8", "surrogatepass")
        if low and self.matched(low):
            strongest = total = 0.0
            for piece in CLAUSE.split(low):
                value = 0.0
                for kind, weight, threat in self.matches(piece.translate(FLAT).split()):
                    out[kind] += weight
                    out["threat"] += threat and kind == "aimed"
                    value += weight if kind in ("aimed", "bare") else 0.0
                strongest, total = max(strongest, value), total + value
            out["any"] = float(any(out[k] > 0 for k in KINDS))
            out["strongest"] = math.log1p(strongest)
            out["density"] = math.log1p(1000 * total / (len(low) + 200))
            for kind in KINDS:
                out[kind] = math.log1p(out[kind])
        return [out[f] for f in FEATURES]


@dataclass
class Model:
    grammar: Grammar
    bias: float
    weights: list[float]

    def score(self, text: str | None) -> float:
        z = self.bias + float(np.dot(self.weights, self.grammar.features(text)))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def entries(text: str | None) -> tuple[set[bytes], set[bytes], set[bytes]]:
    """Words, stems and pairs of a text that may become entries. A stem stands for words longer than it, a pair for two
    words next to each other in a clause."""
    clauses = [piece.translate(FLAT).split() for piece in CLAUSE.split((text or "").lower().encode("utf-8", "surrogatepass"))]
    words = {w for said in clauses for w in said}
    pairs = {b" ".join(p) for said in clauses for p in zip(said, said[1:])}
    letters = [w.decode("utf-8", "replace") for w in words]
    stems = {w[:n].encode() for n in STEM_LENGTHS for w in letters if len(w) > n}
    return words, stems, pairs


def _count(rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per task: in how many toxic and other texts each entry occurs."""
    for frame in rows:
        for some in chunks(frame):
            seen: dict[int, Counter] = {0: Counter(), 1: Counter()}
            for text, toxic in zip(some["text"], some["toxic"]):
                for kind, found in zip("wsp", entries(text)):
                    seen[int(toxic)].update((kind, e) for e in found)
            keys = list(set(seen[0]) | set(seen[1]))
            yield pd.DataFrame({"kind": [k for k, _ in keys], "entry": [e for _, e in keys],
                                "other": [seen[0][k] for k in keys], "toxic": [seen[1][k] for k in keys]})


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.3, rounds: int = 60) -> tuple[float, np.ndarray]:
    """Ridge logistic regression by Newton steps."""
    x1 = np.hstack([np.ones((len(x), 1)), x])
    w, penalty = np.zeros(x1.shape[1]), np.diag([1e-3] + [ridge] * x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x1 @ w, -30, 30)))
        step = np.linalg.solve((x1 * (p * (1 - p))[:, None]).T @ x1 + penalty, x1.T @ (y - p) - penalty @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0]), w[1:]


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """A bounded sample of labelled training rows: text, toxic, and ``part``: whether for the lexicon or the weights."""
    known = labels.where("toxic in (0, 1)").select("doc_id", "toxic").where(learns(F.col("doc_id")))
    share = min(1.0, FIT_ROWS / max(1, known.count()))
    spread = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(1 << 20))
    # At most about FIT_ROWS narrow rows: a bounded side.
    taken = known.where(spread < int(share * (1 << 20))).withColumn("fits", F.pmod(F.xxhash64("doc_id", F.lit(8)), F.lit(5)) == 0)
    return docs.select("doc_id", "text").join(F.broadcast(taken), "doc_id").select("text", "toxic", "fits")


def learns(doc_id):
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(5)) != 0


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    sample = labelled(docs, labels).persist()
    totals = {(r[0], r[1]): r[2] for r in sample.groupBy("fits", "toxic").count().collect()}
    grammar = Grammar({i.encode(): 1.0 for i in INSULTS if " " not in i})
    n0, n1 = totals.get((False, 0), 0), totals.get((False, 1), 0)
    if n0 and n1:
        counts = sample.where("not fits").select("text", "toxic").mapInPandas(_count, "kind string, entry binary, other long, toxic long")
        counts = counts.groupBy("kind", "entry").agg(F.sum("other").alias("other"), F.sum("toxic").alias("toxic"))
        odds = F.log((F.col("toxic") + 0.5) / (n1 + 1.0)) - F.log((F.col("other") + 0.5) / (n0 + 1.0))
        strong = counts.where(F.col("toxic") >= MIN_DOCS).withColumn("odds", odds).where(F.col("odds") >= MIN_ODDS).persist()
        # Pairs have a bound of their own, so that they take no place of a word's.
        best = [strong.where(part).orderBy(F.desc("odds"), "entry").limit(LEXICON_MAX) for part in ("kind <> 'p'", "kind = 'p'")]
        for kind, entry, weight in best[0].unionByName(best[1]).select("kind", "entry", "odds").collect():
            if kind == "p":
                grammar.pairs[tuple(bytes(entry).split(b" "))] = float(weight)
            else:
                (grammar.words if kind == "w" else grammar.stems)[bytes(entry)] = float(weight)
        strong.unpersist()
        grammar = Grammar(grammar.words, grammar.stems, pairs=grammar.pairs)
        # Pairs of ordinary words only: others say what their word says.
        grammar.pairs = {p: w for p, w in grammar.pairs.items() if not any(map(grammar.weight, p))}
    held = [(r[0], r[1]) for r in features(sample.where("fits"), grammar).collect()]
    sample.unpersist()
    y = np.array([t for _, t in held], float)
    if len(set(y.tolist())) < 2:
        # Without weights, what is neither denied nor quoted counts.
        return Model(grammar, -2.0, [6.0 if f == "strongest" else 0.0 for f in FEATURES])
    bias, weights = logistic(np.array([f for f, _ in held]), y)
    return Model(grammar, bias, weights.tolist())


def features(rows: DataFrame, grammar: Grammar) -> DataFrame:
    def build(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame({"f": [grammar.features(t) for t in frame["text"]], "toxic": frame["toxic"]})

    return rows.select("text", "toxic").mapInPandas(build, "f array<double>, toxic int")


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``score``."""

    @F.pandas_udf("double")
    def value(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for some in texts:
            yield pd.Series([model.score(t) for t in some], dtype="float64")

    return docs.withColumn("score", value("text"))


def op3_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    scored = score(docs.select("doc_id", "text"), fit(docs, labels))
    return scored.select("doc_id", (~learns(F.col("doc_id"))).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
