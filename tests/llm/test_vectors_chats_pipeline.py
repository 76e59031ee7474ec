"""Nearest neighbours, preference pairs and the pipeline."""

import math

import numpy as np

import corpus_pipeline
import edge
from edge import SF_SMALL, edge_docs  # noqa: F401  fixtures
from shelfwise.llm import budget_mix, common, mil_quality, multi_index_hash, piece_viterbi, preference_chat
from test_documents import plain_components, plain_lines, plain_shingles


def test_nearest_recall_and_scores(spark):
    vectors = common.table(spark, "/root/testdata/sf0.01", "embeddings")
    got = multi_index_hash.nearest(vectors, vectors.where("vec_id % 20 = 0"), shard=128, query_block=8).collect()
    data = {r.vec_id: np.array(r.embedding, np.float64) for r in vectors.collect()}
    found, right = {}, 0
    for r in got:
        found.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
        assert math.isclose(r.score, float(np.sqrt(((data[r.query_id] - data[r.vec_id]) ** 2).sum())), rel_tol=1e-12)
    for q, rows in found.items():
        best = sorted((float(np.sqrt(((data[q] - v) ** 2).sum())), i) for i, v in data.items() if i != q)[:10]
        assert [r[0] for r in sorted(rows)] == list(range(1, 11))
        assert [(s, i) for _, i, s in sorted(rows)] == sorted((s, i) for _, i, s in rows)
        right += len({i for _, i in best} & {r[1] for r in rows})
    assert right >= 0.9 * 10 * len(found)


def test_nearest_awkward_vectors(spark):
    rows = [(0, [1.0, 0.0], "a"), (1, [0.0, 0.0], "a"), (2, None, "a"), (3, [1.0, None], "a"), (4, [float("nan"), 1.0], "a"),
            (5, [1.0, 1.0], "a"), (6, [1.0, 1.0], "a"), (6, [1.0, 1.0], "a"), (7, [2.0], "a"), (None, [1.0, 0.1], "a"),
            (8, [float("inf"), 1.0], "a"), (9, [0.5, 0.0], "a")]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, rank string")
    got = [(r.query_id, r["rank"], r.vec_id) for r in
           multi_index_hash.nearest(df, df.where("vec_id % 100 = 0")).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 9), (0, 2, 5), (0, 3, 6)]
    assert multi_index_hash.nearest(df.limit(0), df).count() == 0


def test_pigeonhole_probes_find_the_whole_ball():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(3000, 64))
    turn = multi_index_hash.Rotation(x[:500])
    codes, radius = turn.codes(x), 18
    shard = multi_index_hash.Shard(np.arange(3000), x, codes)
    for q in range(0, 3000, 300):
        ids, _ = shard.search(q, x[q], codes[q], multi_index_hash.probes(radius), radius, 1)
        ball = np.flatnonzero(np.bitwise_count(codes ^ codes[q]) <= radius)
        ball = ball[ball != q]
        if len(ball):
            assert ids[0] == ball[np.argmin(((x[ball] - x[q]) ** 2).sum(1))]


def test_preference_pairs(spark):
    side = lambda turns: spark.createDataFrame([(1, n, r, t) for n, (r, t) in enumerate(turns)] +  # noqa: E731
                                               [(None, 0, "user", "x"), (2, 0, None, None)],
                                               "pair_id bigint, turn bigint, role string, text string")
    start = [("system", "be brief"), ("user", "hi <|im_end|>")]
    got = {r.pair_id: r for r in preference_chat.preference_pairs(
        side(start + [("assistant", "yes"), ("user", "ok"), ("assistant", "é!")]), side(start + [("assistant", "no")])).collect()}
    r = got[1]
    assert r.n_prompt_turns == 2 and r.prompt.count("<|im_end|>") == 2 and r.prompt.endswith("< |im_end|><|im_end|>\n")
    cut = [tuple(map(int, s.split(":"))) for s in r.chosen_spans.split(",")]
    assert [r.chosen[a:b] for a, b in cut] == ["yes<|im_end|>", "é!<|im_end|>"]
    a, b = map(int, r.rejected_spans.split(":"))
    assert r.rejected[a:b] == "no<|im_end|>"
    assert got[2].n_prompt_turns == 1 and got[2].chosen == got[2].rejected == "" and None not in got
    empty = side(start).limit(0)
    assert preference_chat.preference_pairs(empty, empty).count() == 0


def plain_mixture(docs):
    """doc_id -> copies, from budgets that the operator gives and a plain walk of each leaf's order."""
    import hashlib

    leaves = {}
    for r in docs:
        if r["tokens"]:
            leaves.setdefault((r["domain"], r["lang"], r["source"]), []).append(r)
    return leaves, lambda epoch, i: hashlib.md5(f"{budget_mix.SEED}:{epoch}:{'' if i is None else i}".encode()).hexdigest()


def test_pipeline_stages_against_plain_versions(spark):
    docs = common.table(spark, SF_SMALL, "documents")
    marks = common.table(spark, SF_SMALL, "labels")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "lines", "near_duplicates", "mixture", "pieces"]
    outs = {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, common.scratch(stage(spark, docs, SF_SMALL), f"test-{name}")
        outs[name] = docs
        if name != "pieces":
            assert docs.columns == before.columns
        old, new = before.collect(), docs.collect()
        texts = {r.doc_id: r.text for r in old}
        if name == "quality":
            table = mil_quality._class_table()
            model = mil_quality.train(before, marks)
            want = {i for i, t in texts.items() if model.score([mil_quality.encode(t, table)])[0] >= mil_quality.THRESHOLD}
            assert {r.doc_id for r in new} == want
        elif name == "lines":
            gone = plain_lines(texts)
            assert {r.doc_id: r.text for r in new} == {i: "\n".join(
                x for n, x in enumerate(t.split("\n")) if (i, n) not in gone) for i, t in texts.items()}
        elif name == "near_duplicates":
            label = plain_components({i: plain_shingles(t) for i, t in texts.items()},
                                     lambda a, b: 100 * len(a & b) >= 75 * len(a | b))
            assert {r.doc_id for r in new} == {i for i, c in label.items() if i == c}
        elif name == "mixture":
            tree = budget_mix.with_tree(before)
            total = int(sum(r.tokens for r in tree.collect()) * budget_mix.SHARE)
            leaves, place = plain_mixture(tree.collect())
            supply = spark.createDataFrame([(*k, sum(r.tokens for r in v)) for k, v in leaves.items()],
                                           "domain string, lang string, source string, supply bigint")
            want = {}
            for b in budget_mix.budgets(supply, budget_mix.LEVELS, total).collect():
                whole, rest = divmod(b.budget, b.supply)
                spent = 0
                for r in sorted(leaves[b.domain, b.lang, b.source], key=lambda r: place(whole, r.id)):
                    spent += r.tokens
                    if whole + (spent <= rest):
                        want[r.id] = whole + (spent <= rest)
            got = {}
            for r in new:
                got[r.doc_id] = got.get(r.doc_id, 0) + 1
            assert got == want
        else:
            import sentencepiece

            lib = sentencepiece.SentencePieceProcessor(model_file=piece_viterbi.MODEL)
            assert all(list(r.ids) == lib.encode(r.text) and r.n_tokens == len(r.ids) for r in new)
    assert corpus_pipeline.run(spark, SF_SMALL).count() == docs.count()


def test_stages_take_awkward_rows(spark, edge_docs):
    docs = edge_docs.select("doc_id", "text", "lang", "source", "n_chars")
    for _, stage in corpus_pipeline.STAGES:
        for some in (docs, docs.limit(0)):
            stage(spark, some, SF_SMALL).collect()
    assert edge.documents()
