"""Toxicity by a lexicon trie met by Levenshtein automata, with context windows.

1. The lexicon is learned from a bounded sample of labelled documents: words,
   and stems (word beginnings), that occur in toxic documents far more often
   than in others. Stems allow no edits; the words seen with a stem are entries
   beside it, which do. It is a bounded list, kept as a trie.
2. The automaton that accepts every word within ``EDITS`` edits of an entry is
   intersected with the trie: states are sets of (trie node, edits used), and
   the sets are made deterministic once, as a transition table. An edit is a
   letter more, less or changed, or two neighbours swapped. A word that an edit
   makes an entry of ``SHORTEST_GUARDED`` letters counts only if no clean
   document of the sample has it. All distinct
   words of a batch advance through the table together, a character a step.
3. Each hit is scored in a window of ``WINDOW`` words to either side: quotation
   marks around it and words of reporting mark a quotation; words of address
   and further hits mark abuse.
4. A logistic regression over exact, misspelled, quoted and addressed hits is
   fitted on the sample, towards prior weights, so kinds of evidence that the
   sample lacks keep a sensible weight.

Scoring reads whole texts in Arrow batches. Defined cases: a null, empty or
blank text has no hits and gets the score of a clean text; without labels the
lexicon is empty and every score is the prior's.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import is_held_out, scratch, training_sample

TRAIN_ROWS = 6000
EDITS = 1
SHORTEST_FUZZY = 5
SHORTEST_GUARDED = 4
SHORTEST_STEM = 4
LONGEST_STEM = 8
STEM_WORDS = 5
ODDS = 25.0
CHANCE = 0.1
WINDOW = 8
THRESHOLD = 0.5
#: Punctuation taken off a word's ends, and words that mark reporting or address.
EDGES = ".,;:!?\"'()[]{}<>«»„“”‘’…*%&$#|-_~`"
QUOTES = "\"«»„“”"
REPORTING = frozenset("said says say called calls wrote word words term quote quoted quotes sagte sagt nannte wort "
                      "zitat dit disait mot terme cite dijo dice palabra cita llamó".split())
ADDRESS = frozenset("you your you're youre u du dich dir ihr euch tu te toi vous tú ti usted ustedes eres".split())
FEATURES = 7
PRIOR = np.array([-3.0, 4.0, 1.0, 0.5, 0.5, 0.5, 1.0])


class Automaton:
    """Transition table over (trie node, edits used) sets for a list of (entry, is stem)."""

    def __init__(self, entries: list[tuple[str, bool]], edits: int = EDITS, shortest: int = SHORTEST_FUZZY,
                 guarded: int = SHORTEST_GUARDED, ordinary: frozenset[str] = frozenset()):
        self.entries, self.ordinary = entries, ordinary
        self.alphabet = {c: i + 1 for i, c in enumerate(sorted({c for w, _ in entries for c in w}))}
        children: list[dict[str, int]] = [{}]
        ends: list[int] = [0]  # bits: 1 a word ends here, 2 a stem does, 4 the word allows edits, 8 only with a guard
        fuzzy: list[bool] = [False]  # an entry that allows edits lies below
        for word, stem in entries:
            node = 0
            for c in word:
                if c not in children[node]:
                    children[node][c] = len(children)
                    children.append({}), ends.append(0), fuzzy.append(False)
                node = children[node][c]
                fuzzy[node] |= len(word) >= min(shortest, guarded) and not stem
            ends[node] |= 2 if stem else 1 | (4 if len(word) >= shortest else 8 if len(word) >= guarded else 0)
        fuzzy[0] = True
        self._children, self._ends, self._fuzzy, self._edits = children, ends, fuzzy, edits
        letters = [None, *self.alphabet]
        start = self._closed({(0, 0, "")})
        states, rows, accepts = {frozenset(): 0, start: 1}, [[0] * len(letters)], [0, self._accepts(start)]
        queue = [start]
        while queue:
            state = queue.pop(0)
            row = []
            for c in letters:
                nxt = self._step(state, c)
                if nxt not in states:
                    states[nxt] = len(states)
                    accepts.append(self._accepts(nxt))
                    queue.append(nxt)
                row.append(states[nxt])
            rows.append(row)
        self.table = np.array(rows, np.int32)
        self.accepts = np.array(accepts, np.int8)
        del self._children, self._ends, self._fuzzy

    def _closed(self, state: set) -> frozenset:
        """With entry letters skipped in the word, which costs an edit and no letter."""
        out, queue = set(state), list(state)
        while queue:
            node, used, late = queue.pop()
            if node >= 0 and used < self._edits and not late:
                for child in self._children[node].values():
                    if self._fuzzy[child] and (child, used + 1, "") not in out:
                        out.add((child, used + 1, "")), queue.append((child, used + 1, ""))
        # a node reached with fewer edits makes the same node with more needless
        return frozenset((n, u, k) for n, u, k in out if k or not any((n, v, "") in out for v in range(u)))

    def _step(self, state: frozenset, c: str | None) -> frozenset:
        """States are (node, edits used, and within a swap the letters (to come, read too early), else empty)."""
        out = set()
        for node, used, late in state:
            if late:
                if c == late[0]:
                    out.add((self._children[self._children[node][c]][late[1]], used, ""))
                continue
            if node < 0 or self._ends[node] & 2 and used == 0:
                out.add((-1, 0, ""))  # past a whole stem: anything may follow
            if node < 0:
                continue
            children = self._children[node]
            if c in children:
                out.add((children[c], used, ""))
            if used < self._edits and self._fuzzy[node]:
                out.add((node, used + 1, ""))  # a letter too many
                out.update((child, used + 1, "") for child in children.values() if self._fuzzy[child])
                out.update((node, used + 1, (x, c)) for x, child in children.items()
                           if x != c and c in self._children[child] and self._fuzzy[self._children[child][c]])
        return self._closed(out)

    def _accepts(self, state: frozenset) -> int:
        """1: an entry or a word with an entry stem, 2: within the edits of an entry, 3: of a guarded one, 0: neither."""
        best = 0
        for node, used, late in state:
            if late:
                continue
            if node < 0 or self._ends[node] and used == 0:
                return 1
            if self._ends[node] & 4:
                best = 2
            elif self._ends[node] & 8 and not best:
                best = 3
        return best

    def match(self, words: list[str]) -> np.ndarray:
        """For each word 0, 1 or 2, as :meth:`_accepts`; a guarded hit is 2, or 0 if the word is an ordinary one."""
        n = len(words)
        if not n:
            return np.zeros(0, np.int8)
        lengths = np.fromiter(map(len, words), np.int64, n)
        codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        top = max(map(ord, self.alphabet), default=0) + 1
        lookup = np.zeros(top + 1, np.int32)
        for c, i in self.alphabet.items():
            lookup[ord(c)] = i
        letters = lookup[np.minimum(codes, top)]
        starts = np.zeros(n, np.int64)
        np.cumsum(lengths[:-1], out=starts[1:])
        state = np.ones(n, np.int32)
        live = np.flatnonzero(lengths > 0)
        step = 0
        while len(live):
            state[live] = self.table[state[live], letters[starts[live] + step]]
            step += 1
            live = live[(state[live] != 0) & (lengths[live] > step)]
        kinds = self.accepts[state]
        for i in np.flatnonzero(kinds == 3):
            kinds[i] = 0 if words[i] in self.ordinary else 2
        return kinds


def clean_word(word: str) -> str:
    return word.strip(EDGES).lower()


def hits(texts: list[str], automaton: Automaton):
    """Per text: (number of words, its words, places of its hits, kinds of its hits)."""
    split = [t.split() for t in texts]
    sizes = [len(w) for w in split]
    flat = [w for words in split for w in words]
    if not flat:
        return [(0, [], np.zeros(0, np.int64), np.zeros(0, np.int8)) for _ in texts]
    which, distinct = pd.factorize(np.array(flat, dtype=object))
    kinds = automaton.match([clean_word(w) for w in distinct])[which]
    out, at = [], 0
    for words, n in zip(split, sizes):
        part = kinds[at: at + n]
        places = np.flatnonzero(part)
        out.append((n, words, places, part[places]))
        at += n
    return out


def features(n: int, words: list[str], places: np.ndarray, kinds: np.ndarray, window: int = WINDOW) -> list[float]:
    exact = fuzzy = quoted = addressed = crowded = 0
    for j, (i, kind) in enumerate(zip(places, kinds)):
        before, after = words[max(0, i - window): i], words[i + 1: i + 1 + window]
        marks = sum(w.count(q) for w in before for q in QUOTES) + sum(words[i][: 1].count(q) for q in QUOTES)
        closing = any(q in w for w in [words[i], *after] for q in QUOTES)
        near = {clean_word(w) for w in before + after}
        if (marks % 2 and closing) or near & REPORTING:
            quoted += 1
        elif kind == 1:
            exact += 1
        else:
            fuzzy += 1
        addressed += bool(near & ADDRESS)
        crowded += bool(j and i - places[j - 1] <= window)
    return [1.0, min(1.5, np.log1p(exact)), min(1.5, np.log1p(fuzzy)), min(1.5, np.log1p(quoted)),
            min(1.5, np.log1p(addressed)), min(1.5, np.log1p(crowded)), min(1.0, 10 * (exact + fuzzy) / max(n, 1))]


def learn_lexicon(sample: DataFrame) -> list[tuple[str, bool]]:
    """Words and stems that mark toxic documents, from (text, label): all that pass the test below."""

    def run(batches):
        for batch in batches:
            terms, stems, labels, first = [], [], [], []
            for text, label in zip(batch.column(0), batch.column(1)):
                words = {clean_word(w) for w in (text.as_py() or "").split()}
                words = {w for w in words if any(c.isalpha() for c in w)}
                for w in words:
                    terms.append(w), stems.append(False), labels.append(label.as_py()), first.append(w)
                for stem, w in {(w[:k], w) for w in words for k in range(SHORTEST_STEM, LONGEST_STEM + 1) if len(w) > k}:
                    terms.append(stem), stems.append(True), labels.append(label.as_py()), first.append(w)
            yield pa.record_batch([pa.array(terms, pa.string()), pa.array(stems, pa.bool_()),
                                   pa.array(labels, pa.float64()), pa.array(first, pa.string())],
                                  names=["term", "stem", "label", "word"])

    numbered = sample.select("text", "label").distinct().withColumn("doc", F.xxhash64("text"))
    totals = numbered.agg(F.sum("label"), F.sum(1 - F.col("label"))).first()
    toxic, clean = float(totals[0] or 0), float(totals[1] or 0)
    if not toxic:
        return []
    counts = scratch(
        numbered.select("text", "label").mapInArrow(run, "term string, stem boolean, label double, word string")
        .groupBy("term", "stem", "word").agg(F.sum("label").alias("t"), F.sum(1 - F.col("label")).alias("c"))
        .groupBy("term", "stem").agg(F.sum("t").alias("t"), F.sum("c").alias("c"), F.count("*").alias("words"),
                                     F.max("t").alias("most")).where("t + c >= 2"), "toxic-terms")
    # Chernoff's bound on the chance that a term spread evenly over the documents lands so often
    # in toxic ones, against the number of terms tried: under CHANCE such terms are expected at all
    share = toxic / (toxic + clean)
    surprise = F.expr(f"(t + c) * ((t / (t + c)) * ln((t / (t + c)) / {share}D)"
                      f" + if(c > 0, (c / (t + c)) * ln((c / (t + c)) / {1 - share}D), 0D))")
    least = float(np.log(max(counts.count(), 1) / CHANCE))
    found = (counts.withColumn("odds", (F.col("t") + 0.5) / (toxic + 1) / ((F.col("c") + 0.5) / (clean + 1)))
             .where((F.col("odds") >= ODDS) & (surprise >= least))
             .where(f"not stem or (words >= {STEM_WORDS} and t >= 1.5 * most)")
             .orderBy(F.col("odds").desc(), "term", "stem").collect()) if clean else []
    stems = {r["term"]: r["t"] for r in found if r["stem"]}
    # of a chain of stems, the longest that still holds nine tenths of the shortest one's hits
    chosen: dict[str, str] = {}
    for stem in sorted(stems, key=len):
        root = next((s for s in (stem[:k] for k in range(SHORTEST_STEM, len(stem))) if s in chosen), stem)
        if root == stem or stems[stem] >= 0.9 * stems[root]:
            chosen[root] = stem
    kept = set(chosen.values())
    words = [r["term"] for r in found if not r["stem"] and not any(r["term"].startswith(s) for s in kept)]
    entries = ([(s, True) for s in sorted(kept)] + [(w, False) for w in words])
    # a stem's words are evidence by their stem; entries of their own, they are found misspelled too
    begin = [F.col("term").startswith(s) for s, stem in entries if stem]
    inside = (counts.where(~F.col("stem") & reduce(or_, begin))
              .where((F.col("t") + 0.5) / (toxic + 1) >= ODDS * (F.col("c") + 0.5) / (clean + 1))
              .orderBy(F.col("t").desc(), "term").collect()) if begin else []
    return entries + [(r["term"], False) for r in inside]


def ordinary_words(sample: DataFrame, automaton: Automaton) -> frozenset[str]:
    """Words of clean documents in the sample that an edit makes a guarded entry."""

    def run(batches):
        for batch in batches:
            words = sorted({clean_word(w) for t in batch.column(0) for w in (t.as_py() or "").split()})
            kinds = automaton.match(words)
            yield pa.record_batch([pa.array([w for w, k in zip(words, kinds) if k == 2], pa.string())], names=["word"])

    if not any(len(w) == SHORTEST_GUARDED and not stem for w, stem in automaton.entries):
        return frozenset()
    found = sample.where("label = 0").select("text").mapInArrow(run, "word string").distinct()
    return frozenset(r["word"] for r in found.collect())


def fit_weights(rows: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Logistic regression by Newton steps, with a Gaussian prior around ``PRIOR``."""
    w = PRIOR.copy()
    if not len(rows):
        return w
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(rows @ w, -30, 30)))
        slope = rows.T @ (p - target) + 0.5 * (w - PRIOR)
        bend = (rows * (p * (1 - p))[:, None]).T @ rows + 0.5 * np.eye(FEATURES)
        w = w - np.linalg.solve(bend, slope)
    return w


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", rows: int = TRAIN_ROWS) -> tuple[Automaton, np.ndarray]:
    sample = scratch(training_sample(docs, labels, label, rows), "toxic-sample")
    automaton = Automaton(learn_lexicon(sample))
    automaton.ordinary = ordinary_words(sample, automaton)

    def run(batches):
        for batch in batches:
            found = [features(*h) for h in hits([t.as_py() or "" for t in batch.column(0)], automaton)]
            yield pa.record_batch([pa.array(found, pa.list_(pa.float64())), batch.column(1)], names=["x", "label"])

    got = sample.select("text", "label").mapInArrow(run, "x array<double>, label double") \
        .toPandas().sort_values(["label", "x"], key=lambda c: c.map(str))
    x = np.array(got["x"].tolist(), np.float64).reshape(-1, FEATURES)
    return automaton, fit_weights(x, got["label"].to_numpy(np.float64))


def toxicity_scores(docs: DataFrame, labels: DataFrame, label: str = "toxic", id_col: str = "doc_id",
                    text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(id, held_out, score, predicted, hits) of every row of ``docs``."""
    named = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    automaton, weights = train(named, labels.withColumnRenamed(id_col, "doc_id") if id_col != "doc_id" else labels, label)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                found = hits([t.as_py() or "" for t in part.column(1)], automaton)
                x = np.array([features(*h) for h in found]).reshape(-1, FEATURES)
                score = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
                yield pa.record_batch([part.column(0), pa.array(score, pa.float64()),
                                       pa.array([len(h[2]) for h in found], pa.int64())], names=["id", "score", "hits"])

    return (named.mapInArrow(run, f"id {kind}, score double, hits bigint")
            .select("id", F.coalesce(is_held_out(F.col("id")), F.lit(False)).alias("held_out"), "score",
                    (F.col("score") >= threshold).cast("int").alias("predicted"), "hits"))
