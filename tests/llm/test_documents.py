"""Operators over documents: awkward rows, empty tables, and plain versions of the same definitions."""

import hashlib
import itertools
import math
import random
import re
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

import edge
from edge import edge_docs, labels, no_docs  # noqa: F401  fixtures
from shelfwise.llm import (budget_mix, common, fuzzy_lines, mil_quality, odd_sketch, order_minhash, piece_viterbi,
                           secret_scan, toxicity)


def rows(df, key="id"):
    return {r[key]: r for r in df.collect()}


# --- order minhash

def plain_edit(docs):
    """id -> (length, sha of the edited text), rows in descending order of the id."""
    docs = sorted({(r[0], r[1] or "") for r in docs if r[0] is not None}, reverse=True)
    docs += [(None, r[1] or "") for r in edge.documents() if r[0] is None]
    out = {}
    for (i, text), (_, following) in zip(docs, docs[1:] + docs[:1]):
        half = len(text) // 2
        new = text[: len(text) - half] + following[:half]
        out[i] = (len(text), hashlib.sha256(new.encode()).hexdigest())
    return out


def test_order_minhash_edits(edge_docs, no_docs):
    unique = edge_docs.dropDuplicates(["doc_id"])
    got = rows(order_minhash.fingerprints(unique))
    want = plain_edit(edge.documents())
    assert {i: (r.n_chars, r.edited_sha256) for i, r in got.items()} == want
    assert got[0].fingerprint == got[1].fingerprint and got[3].fingerprint == got[4].fingerprint
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got.values())
    assert order_minhash.fingerprints(no_docs).count() == 0
    assert order_minhash.fingerprints(edge_docs).count() == len(edge.documents())


def test_order_minhash_ranges_are_seamless(edge_docs):
    small = order_minhash.in_descending_order(edge_docs.where("doc_id is not null").dropDuplicates(["doc_id"]),
                                              "doc_id", "text", rows_per_range=3)
    parts = {}
    for r in small.collect():
        parts.setdefault(r["range"], []).append((r.extra, -r.id))
    order = [[-i for _, i in sorted(parts[k])] for k in sorted(parts)]
    assert len(order) > 2
    assert [i for part in order for i in part[:-1]] == sorted((i for p in order for i in p[:-1]), reverse=True)
    for a, b in zip(order, order[1:] + order[:1]):
        assert a[-1] == b[0]


def plain_fingerprint(text, k, tuple_size, coordinates):
    """Order MinHash one coordinate after the other: the smallest numbered k-mers from a point on, in text order."""
    kmers = [text[i: i + k] for i in range(len(text) - k + 1)] or [text]
    value = {m: int(order_minhash._kmers(order_minhash._codes(m), k)[0]) >> 24 for m in set(kmers)}
    mix = lambda x: int(order_minhash._mix(np.array([x % 2**64], np.uint64))[0])
    seen, numbered = {}, []
    for m in kmers:
        seen[m] = seen.get(m, -1) + 1
        numbered.append(mix(value[m] * int(order_minhash._ODD) + seen[m]))
    out = []
    for c in range(coordinates):
        point = c * (2**64 // coordinates) >> 24
        order = sorted(range(len(kmers)), key=lambda i: (numbered[i] >> 24 < point, numbered[i] >> 24, i))
        h = tuple_size
        for i in sorted(order[:tuple_size]):
            h = mix(h * int(order_minhash._ODD) + numbered[i])
        out.append(h >> 48)
    return out


@pytest.mark.parametrize("k, tuple_size, coordinates", [(12, 2, 128), (3, 3, 16), (5, 1, 8)])
def test_order_minhash_equals_plain(k, tuple_size, coordinates):
    rng = random.Random(k)
    texts = ["", "a", "aaaaaaaaaaaaaaaaaaaaaaaa", "abc" * 30, "日本語テキスト" * 5, edge.prose(rng, 60)]
    for text in texts:
        got = order_minhash.fingerprint(order_minhash._codes(text), k, tuple_size, coordinates)
        assert got.tolist() == plain_fingerprint(text, k, tuple_size, coordinates), text


def test_order_minhash_prefers_order():
    text = edge.prose(random.Random(1), 200)
    same = order_minhash.fingerprint(order_minhash._codes(text))
    half = len(text) // 2
    moved = order_minhash.fingerprint(order_minhash._codes(text[half:] + text[:half]))
    edited = order_minhash.fingerprint(order_minhash._codes(text[:half] + "x" + text[half:]))
    assert order_minhash.likeness(same, same) == 1
    assert order_minhash.likeness(same, edited) > order_minhash.likeness(same, moved)


# --- near duplicates

def plain_components(sets, link):
    label = {i: i for i in sets}
    pairs = [(a, b) for a, b in itertools.combinations(sets, 2) if sets[a] and sets[b] and link(sets[a], sets[b])]
    changed = True
    while changed:
        changed = False
        for a, b in pairs:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    return label


def plain_shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(words[i: i + 5]) for i in range(len(words) - 4)} if len(words) > 4 else {tuple(words)} - {()}


def near_texts(n=60):
    rng = random.Random(9)
    texts = {}
    for g in range(6):
        base = edge.prose(rng, 80).split()
        for k in range(n // 6):
            words = list(base)
            for _ in range(rng.randrange(4)):
                words[rng.randrange(80)] = "w" + str(rng.randrange(10 ** 6))
            texts[g * 100 + k] = " ".join(words)
    return texts


def test_near_duplicates_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(odd_sketch, "BLOCK", 4)
    texts = near_texts()
    got = rows(odd_sketch.near_duplicates(spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")))
    sets = {i: plain_shingles(t) for i, t in texts.items()}
    want = plain_components(sets, lambda a, b: 100 * len(a & b) >= 75 * len(a | b))
    assert {i: r.component_id for i, r in got.items()} == want
    assert all(r.n_shingles == len(sets[i]) and r.kept == (i == r.component_id) for i, r in got.items())


def test_near_duplicates_awkward_rows(edge_docs, no_docs):
    found = odd_sketch.near_duplicates(edge_docs).collect()
    assert len(found) == len(edge.documents())
    got = {r.id: r for r in found}
    assert got[1].component_id == got[2].component_id == got[None].component_id == 0
    assert [got[i].n_shingles for i in (3, 4, 5)] == [0, 0, 0] and all(got[i].kept for i in (3, 4, 5))
    assert got[7].component_id == 6
    assert odd_sketch.near_duplicates(no_docs).count() == 0


def test_odd_sketch_counts_differing_samples():
    rng = np.random.default_rng(2)
    a = rng.integers(0, 2**63, 800, dtype=np.uint64)
    b = np.r_[a[:640], rng.integers(0, 2**63, 160, dtype=np.uint64)]
    (_, x), (_, y) = odd_sketch.sketch(np.unique(a)), odd_sketch.sketch(np.unique(b))
    apart = int(np.bitwise_count((x ^ y).view(np.uint64)).sum())
    bits, k = 64 * odd_sketch.SKETCH_LONGS, odd_sketch.PERMUTATIONS
    estimate = 1 + bits / (4 * k) * np.log(1 - 2 * apart / bits)
    assert abs(estimate - 640 / 960) < 0.15


# --- lines

def plain_lines(docs):
    first, sets = {}, {}
    where = [((i, n), line) for i, t in docs.items() for n, line in enumerate((t or "").split("\n")) if line.strip(" \t\r")]
    for at, line in where:
        first.setdefault(line, at)
        first[line] = min(first[line], at)
    for line in first:
        sets[line] = {line[i: i + fuzzy_lines.CHARS] for i in range(max(len(line) - fuzzy_lines.CHARS + 1, 1))}
    label = plain_components(sets, lambda a, b: len(a & b) >= fuzzy_lines.SIMILARITY * len(a | b))
    stays = {}
    for line in first:
        stays[label[line]] = min(stays.get(label[line], first[line]), first[line])
    return {at for at, line in where if stays[label[line]] != at}


def test_lines_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(fuzzy_lines, "BLOCK", 4)
    rng = random.Random(5)
    pool = [edge.prose(rng, rng.randrange(1, 40)).split() for _ in range(25)]
    docs = {}
    for i in range(40):
        lines = []
        for _ in range(rng.randrange(6)):
            words = list(rng.choice(pool))
            if rng.random() < 0.5:
                words[rng.randrange(len(words))] = "n" + str(rng.randrange(99))
            lines.append(" ".join(words))
        docs[i] = "\n".join(lines)
    df = spark.createDataFrame(list(docs.items()), "doc_id bigint, text string")
    got = {(r.id, r.at) for r in fuzzy_lines.dropped_lines(df).where("drop").collect()}
    want = plain_lines(docs)
    assert got <= want and len(got) >= 0.99 * len(want)
    texts = {r.doc_id: r.text for r in fuzzy_lines.dedup_lines(df).collect()}
    assert texts == {i: "\n".join(x for n, x in enumerate(t.split("\n")) if (i, n) not in got) for i, t in docs.items()}


def _shared_bands(lines):
    keys, ends = fuzzy_lines.shingle_keys(lines)
    values, offsets = fuzzy_lines.bands(keys, ends)
    return [set(values[offsets[i]: offsets[i + 1]].tolist()) for i in range(len(lines))]


def _near_pairs(n, count, rng):
    """Pairs of lines of ``n`` characters or more whose shingle sets are as far apart as 0.75 allows."""
    letters = "abcdefghijklmnopqrstuvwxyz "
    grams = lambda x: {x[i: i + 5] for i in range(max(len(x) - 4, 1))}
    while count:
        line = other = "".join(rng.choice(letters) for _ in range(n))
        while True:
            at = rng.randrange(len(other) + 1)
            edited = other[:at] + rng.choice("0123456789") + other[at + rng.randrange(2):]
            x, y = grams(line), grams(edited)
            if len(x & y) < 0.75 * len(x | y):
                break
            other = edited
        if other != line:
            yield line, other
        count -= 1


def test_lines_at_the_threshold_share_a_band():
    rng = random.Random(6)
    for n, count in [*((n, 30) for n in range(7, 47)), (60, 1000), (100, 1000), (300, 300)]:
        pairs = list(_near_pairs(n, count, rng))
        sets = _shared_bands([line for pair in pairs for line in pair])
        met = sum(bool(a & b) for a, b in zip(sets[::2], sets[1::2]))
        # sets of at most SHORT always meet; of the larger a few in 10,000 needn't
        assert met == len(pairs) if n <= fuzzy_lines.SHORT else met >= 0.99 * len(pairs), n


def test_line_keys_are_sparks(spark):
    lines = ["a", "é€😀 line", "x" * 100]
    df = spark.createDataFrame([(0, "\n".join(lines))], "doc_id bigint, text string")
    want = spark.createDataFrame([(x,) for x in lines], "line string").select(*fuzzy_lines._key(F.col("line")))
    got = fuzzy_lines.signatures(df)
    assert {tuple(r) for r in got.select("k1", "k2").collect()} == {tuple(r) for r in want.collect()}
    assert {r.at: r.size for r in got.collect()} == {0: 1, 1: 4, 2: 1}


def test_lines_without_spaces_and_short_lines_have_near_copies(spark):
    url = "https://host.example/path/to/some/page?with=args&and=more"
    docs = {0: url, 1: url + "1", 2: "abc", 3: "abc\0", 4: "abcd", 5: "ab\nab", 6: None, 7: "字" * 3 + "一二三四五六七八九十" * 2,
            8: "字" * 3 + "一二三四五六七八九十" * 2 + "。"}
    got = {(r.id, r.at) for r in fuzzy_lines.dropped_lines(spark.createDataFrame(
        list(docs.items()), "doc_id bigint, text string")).where("drop").collect()}
    assert got == plain_lines(docs) == {(1, 0), (5, 1), (8, 0)}


def test_blocks_find_what_hubs_leave(spark, monkeypatch):
    monkeypatch.setattr(fuzzy_lines, "BLOCK", 8)
    monkeypatch.setattr(fuzzy_lines, "HUBS", 1)
    monkeypatch.setattr(fuzzy_lines, "YIELD", 1)
    rng = random.Random(8)
    stem = "".join(rng.choice("abcdefgh") for _ in range(60))
    tails = ["".join(rng.choice("ijklmnop") for _ in range(60)) for _ in range(25)]
    docs = dict(enumerate(stem + t + x for t in tails for x in ("", "!", "?!")))
    got = {(r.id, r.at) for r in fuzzy_lines.dropped_lines(spark.createDataFrame(
        list(docs.items()), "doc_id bigint, text string")).where("drop").collect()}
    assert got == plain_lines(docs) == {(i, 0) for i in docs if i % 3}


def test_dedup_lines_repeated_and_null_ids(spark):
    rows = [(None, "one line of text\nother words here"), (None, "one line of text\nand a third sentence"),
            (7, "and a third sentence\nunlike all the rest"), (7, "fresh material\none line of text")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = sorted((r.doc_id or 0, r.text) for r in fuzzy_lines.dedup_lines(df).collect())
    assert got == [(0, "one line of text\nand a third sentence"), (0, "one line of text\nother words here"),
                   (7, "fresh material"), (7, "unlike all the rest")]


def test_lines_awkward_rows(edge_docs, no_docs):
    out = fuzzy_lines.dedup_lines(edge_docs)
    assert out.columns == edge_docs.columns
    got = {r.doc_id: r.text for r in out.collect()}
    assert got[3] is None and got[4] == "" and got[5] == "   \n\t " and got[1] == ""
    assert got[9].count("\n") == 0 and got[14] == "x" * 5000
    assert fuzzy_lines.dedup_lines(no_docs).count() == 0


# --- secrets

def plain_spans(text):
    found = []
    for no, rule in enumerate(secret_scan.RULES):
        pattern = {"access": "AKIA[A-Z0-9]+", "hex": "[0-9a-f]+"}.get(rule.kind, rule.pattern)
        for m in re.finditer(pattern, text or "", re.ASCII):
            if len(m.group(rule.group)) >= rule.least:
                found.append((m.start(), no, m.end()))
    return ",".join(f"{secret_scan.RULES[n].kind}:{a}:{b}" for a, n, b in sorted(found))


def test_secrets_equal_plain_scan(edge_docs, no_docs):
    for r in secret_scan.secret_spans(edge_docs).select("id", secret_scan.joined("spans").alias("s")).collect():
        text = next(d[1] for d in edge.documents() if d[0] == r.id)
        assert r.s == plain_spans(text), r.id
    assert secret_scan.secret_spans(no_docs).count() == 0


def test_trigram_queries():
    holds = lambda q, t: (True if q == secret_scan.ANY else q[1] in t if q[0] == "has" else
                          (all if q[0] == "and" else any)(holds(x, t) for x in q[1:]))
    for pattern, text in [("abcd", "xabcdx"), ("ab(c|d)e+f", "abdef"), ("(foo|ba[rz])qux?", "bazqu"), ("a?bcd", "bcd")]:
        assert re.search(pattern, text) and holds(secret_scan.trigram_query(pattern), text)
    assert secret_scan.trigram_query("[a-z]+") == secret_scan.ANY
    assert not holds(secret_scan.trigram_query("password"), "passwort")


# --- mixture

def test_budgets_move_shortages_to_siblings_first(spark):
    leaves = spark.createDataFrame([("a", "x", 10), ("a", "y", 1000), ("b", "z", 1000)], "l0 string, l1 string, supply bigint")
    got = {(r.l0, r.l1): r.budget for r in budget_mix.budgets(leaves, ["l0", "l1"], 400, ({}, {}), 1).collect()}
    assert got == {("a", "x"): 10, ("a", "y"): 190, ("b", "z"): 200}
    got = {(r.l0, r.l1): r.budget for r in budget_mix.budgets(leaves, ["l0", "l1"], 1900, ({"a": 30}, {}), 1).collect()}
    assert got == {("a", "x"): 10, ("a", "y"): 1000, ("b", "z"): 890}


def test_mixture_awkward_rows(edge_docs, no_docs):
    out = budget_mix.mixed(edge_docs)
    assert out.columns == edge_docs.columns and out.count() > 0
    assert out.where("text is null or text = ''").count() == 0
    chosen = budget_mix.mix(budget_mix.with_tree(edge_docs), budget_mix.LEVELS).collect()
    assert sum(r.tokens * r.copies for r in chosen) <= budget_mix.SHARE * sum(-(-len((d[1] or "").encode()) // 4)
                                                                             for d in edge.documents())
    assert budget_mix.mixed(no_docs).count() == 0


# --- pieces

def test_pieces_equal_the_library(edge_docs, no_docs):
    import sentencepiece

    lib = sentencepiece.SentencePieceProcessor(model_file=piece_viterbi.MODEL)
    encoded = piece_viterbi.encode_texts(edge_docs)
    assert encoded.columns == [*edge_docs.columns, "ids"]
    for r in encoded.collect():
        assert list(r.ids) == lib.encode(r.text or "")
    back = {r.doc_id: r.text for r in piece_viterbi.decode_ids(encoded).collect()}
    assert all(back[d[0]] == (d[1] or "") for d in edge.documents())
    assert piece_viterbi.encode_texts(no_docs).count() == 0


def test_pieces_of_odd_strings(monkeypatch):
    import sentencepiece

    monkeypatch.setattr(piece_viterbi, "CODES_AT_ONCE", 60)
    lib = sentencepiece.SentencePieceProcessor(model_file=piece_viterbi.MODEL)
    rng = random.Random(8)
    texts = [" ", "  a   b ", "\n\n\tif(x==1):\n", "aaaaaaaaaaaaaaaaaaaaaaaa", "naïve Ünïcödé", "1234567 890", "a\u0000b"]
    texts += ["".join(rng.choice("abcdehilnorst   THE.,=<>01é") for _ in range(300)) for _ in range(60)]
    for text, ids in zip(texts, piece_viterbi.Encoder(piece_viterbi.load()).encode(texts)):
        assert ids.tolist() == lib.encode(text), text


def model_file(path, kind, scored, with_bytes=True):
    """A vocabulary file written by hand: ``scored`` is a list of (piece, score); kind 1 is unigram, 2 is BPE."""
    def number(n):
        out = bytearray()
        while n > 127:
            out.append(n & 127 | 128)
            n >>= 7
        return bytes([*out, n])

    field = lambda at, body: number(at << 3 | 2) + number(len(body)) + body
    flag = lambda at, n: number(at << 3) + number(n)
    piece = lambda text, score, what: field(1, field(1, text.encode()) + b"\x15" + struct.pack("<f", score) + flag(3, what))
    body = piece("<unk>", 0, 2) + piece("<s>", 0, 3) + piece("</s>", 0, 3)
    if with_bytes:
        body += b"".join(piece(f"<0x{b:02X}>", 0, 6) for b in range(256))
    body += b"".join(piece(p, x, 1) for p, x in scored)
    body += field(2, flag(3, kind) + (flag(35, 1) if with_bytes else b"")) + field(3, flag(3, 1) + flag(4, 0) + flag(5, 1))
    path.write_bytes(body)
    return str(path)


def best_path(text, scores):
    """The highest sum of scores over all segmentations, one position after the other."""
    unknown = min(scores.values()) - 10
    sums = [0.0]
    for i in range(1, len(text) + 1):
        sums.append(max(sums[j] + scores.get(text[j:i], unknown if i - j == 1 else -math.inf) for j in range(i)))
    return sums[-1]


def test_pieces_of_a_unigram_model(spark, tmp_path):
    import sentencepiece

    rng = random.Random(12)
    scores = {c: -9.0 - rng.random() for c in "abcdeé\u2581"}
    while len(scores) < 300:
        scores["".join(rng.choice("abcdeé\u2581") for _ in range(rng.randrange(2, 7)))] = -3 - 9 * rng.random()
    scores["ab" * 20] = -2.5  # longer than any other piece
    file = model_file(tmp_path / "unigram.model", 1, scores.items())
    lib = sentencepiece.SentencePieceProcessor(model_file=file)
    scores = {p: lib.get_score(lib.piece_to_id(p)) for p in scores}
    texts = ["", " ", "a", "x", "xyz ab", "ab" * 45, "日本 ab", "a" * 3000]
    texts += ["".join(rng.choice("abcdeé   x") for _ in range(rng.randrange(1, 80))) for _ in range(300)]
    vocabulary = piece_viterbi.load(file)
    found = [x.tolist() for x in piece_viterbi.Encoder(vocabulary).encode(texts)]
    unknown = min(scores.values()) - 10

    def total(ids):  # a code point spelled in bytes counts once, by its first byte
        names = [vocabulary.pieces[i] for i in ids]
        firsts = [n for n in names if n in scores or not 0x80 <= int(n[3:5], 16) < 0xC0]
        return sum(scores.get(n, unknown) for n in firsts)

    same = 0
    for text, ids in zip(texts, found):
        best = best_path("\u2581" + text.replace(" ", "\u2581"), scores) if text else 0.0
        assert abs(total(ids) - best) < 1e-6 * max(1, len(text)), text
        other = lib.encode(text)
        assert ids == other or abs(total(other) - best) < 1e-3, text  # equal sums: rounding picks one
        same += ids == other
    assert same >= 0.9 * len(texts)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    back = piece_viterbi.decode_ids(piece_viterbi.encode_texts(df, model=file), model=file)
    assert {r.doc_id: r.text for r in back.collect()} == dict(enumerate(texts))


def test_piece_models_of_other_kinds(tmp_path):
    import sentencepiece

    merges = ["ab", "abab", "\u2581a", "abababab" * 6]
    file = model_file(tmp_path / "bpe.model", 2, [(p, -float(i)) for i, p in enumerate([*merges, *"ab\u2581"])])
    lib = sentencepiece.SentencePieceProcessor(model_file=file)
    texts = ["abab aab", "ab" * 40, "ba ba"]
    assert [x.tolist() for x in piece_viterbi.Encoder(piece_viterbi.load(file)).encode(texts)] == [lib.encode(t) for t in texts]
    with pytest.raises(ValueError, match="no pieces for bytes"):
        piece_viterbi.load(model_file(tmp_path / "none.model", 1, [("a", -1.5)], with_bytes=False))


# --- classifiers

@pytest.mark.parametrize("scores", [mil_quality.quality_scores, toxicity.toxicity_scores])
def test_scores_awkward_rows(scores, spark, edge_docs, no_docs, labels):
    got = scores(edge_docs, labels).collect()
    assert len(got) == len(edge.documents())
    assert all(0 <= r.score <= 1 and r.predicted in (0, 1) for r in got)
    assert scores(no_docs, labels).count() == 0
    none = scores(edge_docs, labels.limit(0)).collect()
    assert len({r.score for r in none}) == 1 or scores is toxicity.toxicity_scores


def accuracy(spark, scores, label):
    docs, marks = (common.table(spark, "/root/testdata/sf0.01", t) for t in ("documents", "labels"))
    both = scores(docs, marks).join(marks.withColumnRenamed("doc_id", "id"), "id").where("held_out").collect()
    assert len(both) > 40
    return sum(r[label] == r.predicted for r in both) / len(both)


def test_quality_held_out(spark):
    assert accuracy(spark, mil_quality.quality_scores, "quality") >= 0.93


def test_toxicity_held_out(spark):
    assert accuracy(spark, toxicity.toxicity_scores, "toxic") >= 0.95


def test_attention_score_equals_plain():
    rng = np.random.default_rng(4)
    net = mil_quality.GatedAttention()
    net.mean, net.scale = rng.normal(size=mil_quality.FEATURES), rng.uniform(0.5, 2, mil_quality.FEATURES)
    bags = [rng.normal(size=(n, mil_quality.FEATURES)) * 3 for n in (1, 4, 2, 70)]
    p = {k: x.tolist() for k, x in net.p.items()}
    dot = lambda x, y: sum(a * b for a, b in zip(x, y))
    times = lambda x, m: [dot(x, column) for column in zip(*m)]
    squash = lambda x: 1 / (1 + math.exp(-x))
    want = []
    for bag in bags:
        hidden, weights = [], []
        for row in bag.tolist():
            x = [min(6, max(-6, (v - m) / d)) for v, m, d in zip(row, net.mean.tolist(), net.scale.tolist())]
            h = [math.tanh(a + b) for a, b in zip(times(x, p["W"]), p["b"])]
            gated = [math.tanh(a) * squash(b) for a, b in zip(times(h, p["V"]), times(h, p["U"]))]
            hidden.append(h), weights.append(math.exp(dot(gated, p["w"])))
        z = [sum(w * h[i] for w, h in zip(weights, hidden)) / sum(weights) for i in range(mil_quality.HIDDEN)]
        want.append(squash(dot(z, p["c"]) + p["o"][0]))
    assert np.allclose(net.score(bags), want, atol=1e-9)


def test_attention_gradient_is_right():
    rng = np.random.default_rng(0)
    net = mil_quality.GatedAttention()
    sizes = np.array([3, 1, 5])
    starts, x, y = np.r_[0, np.cumsum(sizes)[:-1]], rng.normal(size=(9, mil_quality.FEATURES)), np.array([1.0, 0, 1])
    loss = lambda: -np.mean(np.log(np.where(y == 1, (p := net._forward(x, starts, sizes)["y"]), 1 - p)))
    grad = net._gradients(net._forward(x, starts, sizes), starts, sizes, y)
    for k, at in (("W", (3, 4)), ("V", (2, 1)), ("U", (5, 7)), ("w", (3,)), ("c", (2,)), ("o", (0,))):
        net.p[k][at] += 1e-6
        up = loss()
        net.p[k][at] -= 2e-6
        assert abs((up - loss()) / 2e-6 - grad[k][at]) < 1e-5
        net.p[k][at] += 1e-6


def test_automaton_equals_edit_distance():
    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row = row, [i]
            for j, z in enumerate(b, 1):
                row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != z)))
        return row[-1]

    entries = [("stupid", False), ("moron", False), ("bad", False), ("lowei", True)]
    auto = toxicity.Automaton(entries)
    rng = random.Random(4)
    words = ["stupid", "stupd", "st*pid", "sstupid", "stuupidd", "moron", "moran", "bd", "bad", "loweixyz", "lowe", ""]
    words += ["".join(rng.choice("stupidmoronlwe") for _ in range(rng.randrange(1, 9))) for _ in range(2000)]
    for word, got in zip(words, auto.match(words)):
        exact = word in ("stupid", "moron", "bad") or word.startswith("lowei")
        near = min(distance(word, w) for w in ("stupid", "moron")) <= 1
        assert got == (1 if exact else 2 if near else 0), word


def test_automaton_swaps_and_guarded_words():
    auto = toxicity.Automaton([("idiot", False), ("scum", False), ("bad", False)], ordinary=frozenset({"scam"}))
    words = ["idiot", "idoit", "diiot", "idito", "idoti", "ldiot", "scum", "scmu", "csum", "scun", "scam", "bda", "tidio"]
    assert auto.match(words).tolist() == [1, 2, 2, 2, 0, 2, 1, 2, 2, 2, 0, 0, 0]


def test_lexicon_finds_words_of_stems_and_rare_words_misspelled(spark):
    rng = random.Random(8)
    ends = ["", "s", "ic", "ish", "ical", "dom"]
    rows = []
    for i in range(3000):
        toxic = i % 3 == 0
        bad = "" if not toxic else " scum" if i % 90 == 0 else " idiot" + ends[i // 3 % len(ends)]
        rows.append((edge.prose(rng, 12) + bad, float(toxic)))
    entries = toxicity.learn_lexicon(spark.createDataFrame(rows, "text string, label double"))
    auto = toxicity.Automaton(entries)
    assert any(stem and "idiotish".startswith(w) for w, stem in entries) and ("idiotish", False) in entries
    assert auto.match(["ldiot", "iddiot", "idoit", "idoitish", "scum", "scmu"]).tolist() == [2, 2, 2, 2, 1, 2]


def test_quotation_differs_from_abuse():
    auto = toxicity.Automaton([("stupid", False)])
    quoted, plain = (toxicity.features(*toxicity.hits([t], auto)[0]) for t in
                     ('he said "stupid" is a word', "you are stupid today my friend"))
    assert quoted[3] > 0 and quoted[1] == 0 and plain[1] > 0 and plain[4] > 0


# --- components

def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 140)] + [(7, 7), (None, 3)]
    got = {r.node: r.component for r in common.min_label_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{k: 100 for k in range(100, 140)}}


def test_bit_filter_lets_all_members_through(spark):
    ids = spark.range(0, 1000, 7).withColumnRenamed("id", "x")
    kept = common.maybe_in(spark.range(1000).withColumnRenamed("id", "x"), "x", common.bit_filter(ids, "x"))
    assert sorted(r.x for r in kept.collect()) == list(range(0, 1000, 7))
