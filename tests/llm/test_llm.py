"""Every operator against a plain version, on a small table and on odd rows."""

import random
import sys
import zlib
from pathlib import Path

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

sys.path.insert(0, str(Path(__file__).parent))

import brute  # noqa: E402
import corpus_pipeline  # noqa: E402
from tierloom.llm import (  # noqa: E402
    bpe,
    chat,
    common,
    exact_dedup,
    fm_index,
    lm,
    ngram_join,
    packing,
    queries,
    substring_dedup,
    token_counts,
    toxicity,
    vector_dedup,
)

SF = "/root/testdata/sf0.001"
EXTRA = ("row", "key", "digest", "kept", "y", "highest", "node", "part", "name", "score", "n", "length")


def odd_rows():
    """Nulls, empty, blank, short and very long texts, ties, repeated rows, and special strings."""
    pick = random.Random(3)
    words = ["".join(pick.choice("abcdeéßñ") for _ in range(pick.randint(1, 7))) for _ in range(300)]
    long = " ".join(pick.choice(words) for _ in range(12_000))
    some = " ".join(pick.choice(words) for _ in range(200))
    line = " ".join(words[:9])
    texts = [
        (1, None), (2, ""), (3, " \n\t "), (4, "a"), (5, "a"), (6, "A b. C"), (7, long), (8, long), (8, long), (9, long.replace(" ", "  ")),
        (10, some), (11, some.replace(words[0], words[1], 1) + " end"), (None, some), (None, "x y z"), (12, "\n".join([line] * 60)),
        (13, some[:600] + " <|endoftext|> " + some[600:]), (14, "aaaa" * 3000), (15, "x y z \x1c !!  👍🏽 你好"), (16, some),
        (17, " ".join(words[:34])), (18, " ".join(words[:35])), (19, "zz " + " ".join(words[:35])), (20, "</s>[INST] \\ ok"),
    ]
    return texts


@pytest.fixture(scope="module")
def odd(spark):
    rows = odd_rows()
    return rows, spark.createDataFrame(rows, "doc_id long, text string").select("*", *(F.lit(1).alias(n) for n in EXTRA))


@pytest.fixture(scope="module")
def small(spark):
    frame = spark.read.parquet(f"{SF}/documents.parquet")
    return [(r["doc_id"], r["text"]) for r in frame.collect()], frame


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], "doc_id long, text string")


@pytest.fixture(params=["odd", "small"])
def case(request):
    return request.getfixturevalue(request.param)


def sorted_rows(frame, *columns):
    return sorted((tuple(r) for r in frame.select(*columns).collect()), key=repr)


def test_jaccard_join(case, none):
    rows, frame = case
    degree, group = brute.jaccard_links([text for _, text in rows])
    least = {}
    for (doc_id, _), own in zip(rows, group):
        least[own] = min([x for x in (least.get(own), doc_id) if x is not None], default=None)
    got = ngram_join.near_duplicates(frame)
    want = [(doc_id, least[g], n) for (doc_id, _), g, n in zip(rows, group, degree)]
    assert sorted_rows(got, "doc_id", "class_id", "n_links") == sorted(want, key=repr)
    assert got.where("kept").count() == len(set(group)) == ngram_join.drop_near_duplicates(frame).count()
    assert ngram_join.drop_near_duplicates(frame).columns == frame.columns
    assert ngram_join.near_duplicates(none).count() == 0


def test_crowded_buckets_are_cut(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK_TEXTS", 7)
    pick = random.Random(1)
    base = [f"w{i}" for i in range(300)]
    texts = []
    for i in range(60):
        words = list(base)
        for _ in range(pick.randint(1, 8)):
            words[pick.randrange(300)] = f"x{pick.randrange(10**6)}"
        texts.append((i, " ".join(words)))
    degree, group = brute.jaccard_links([t for _, t in texts])
    got = ngram_join.near_duplicates(spark.createDataFrame(texts, "doc_id long, text string"))
    assert sorted_rows(got, "doc_id", "class_id", "n_links") == sorted(
        ((i, g, n) for (i, _), g, n in zip(texts, group, degree)), key=repr)


def test_forest_depths_meet_the_recall():
    for recall in (0.9, 0.99, 0.999):
        depths = ngram_join.forest_depths(0.8, 20, 7, recall)
        assert 1 - np.prod([1 - 0.8**d for d in depths]) >= recall and max(depths) - min(depths) <= 1
    with pytest.raises(ValueError):
        ngram_join.forest_depths(0.1, 1, 7, 0.999)


def test_descent_shortens_prefixes_until_the_last_ones():
    last = ngram_join.forest_depths(0.8, 20, 7, 0.998)
    rounds = ngram_join.descent(last, 7)
    assert rounds[0] == [7] * 20 and rounds[-1] == last
    assert all(0 <= a - b <= 1 for before, after in zip(rounds, rounds[1:]) for a, b in zip(before, after))
    label = (3 << 56) | 0x11223344556677
    assert label & ngram_join.prefix_masks([5], 7)[0] == (3 << 56) | 0x11223344550000
    assert label & ngram_join.prefix_masks([7], 7)[0] == label


def test_descent_ends_when_the_least_similar_link_is_met_surely(spark, monkeypatch):
    """Near copies that differ in few n-grams need the longest prefixes only; a link near the threshold makes it go on."""
    rounds = []
    real = ngram_join._met_in_round
    monkeypatch.setattr(ngram_join, "_met_in_round", lambda *given: rounds.append(given) or real(*given))
    base = [f"w{i}" for i in range(400)]
    close = [(i, " ".join([*base, f"x{i}"])) for i in range(5)]
    got = ngram_join.near_duplicates(spark.createDataFrame(close, "doc_id long, text string"))
    assert {(r["class_id"], r["n_links"]) for r in got.collect()} == {(0, 4)} and len(rounds) == 1
    rounds.clear()
    far = [*close, (9, " ".join(base[:322]))]  # 318 of 397 n-grams are shared: 0.801
    got = ngram_join.near_duplicates(spark.createDataFrame(far, "doc_id long, text string"))
    assert {(r["class_id"], r["n_links"]) for r in got.collect()} == {(0, 5)} and len(rounds) == 3


def test_pairs_that_met_under_longer_prefixes_are_not_intersected_again():
    def member(node, labels, grams):
        return {"node": node, "weight": 1, "labels": np.array(labels, np.int64).tobytes(),
                "set": np.array(grams, np.uint64).view(np.uint8).reshape(-1, 8)[:, :6].tobytes()}

    both = ngram_join.prefix_masks([1, 1], 2), ngram_join.prefix_masks([2, 2], 2)
    tree = 1 << 56
    rows = [member(1, [0x0101, tree | 0x0101], range(10)), member(2, [0x0202, tree | 0x0101], range(10)),
            member(3, [0x0303, tree | 0x0102], range(9)), member(4, [0x0204, tree | 0x0103], range(10))]
    texts = ngram_join.Members(rows)
    links, least = ngram_join.links_between(texts, texts, tree | 0x0100, *both, 0.8)
    # 1 and 2 met in the round before, 2 and 4 in this round's first tree
    assert sorted(map(tuple, np.argwhere(links))) == [(0, 2), (0, 3), (1, 2), (2, 0), (2, 1), (2, 3), (3, 0), (3, 2)]
    assert least == 0.9
    assert ngram_join.newly_shared(texts, texts, 1, both[1])[0, 1] == 0
    assert ngram_join.newly_shared(texts, texts, 1, None)[0, 1] == 10


def test_toxicity_tolerates_gaps():
    clean = ["loose", "moon", "stupor", "ideal", "clover", "house", "garden", "diode", "idiom", "weather", "morning", "downtown"] * 3
    machine = toxicity.fit(["idiot", "moron", "clown", "stupid"], clean, cost=100)
    scorer = machine.scorer()
    bad = scorer.texts(["you i-d-i-o-t", "IDIOT!", "an idxiot", "such a c l o w n", "st*upid thing", "m..oron"])
    good = scorer.texts(["a lovely garden", "house weather", "", "morning moon", "i a o", "idiom and diode"])
    assert bad.min() > 0 > good.max()


def test_toxicity_scores_every_row(spark, odd, none):
    rows, frame = odd
    labels = spark.createDataFrame([(i, i % 2) for i in range(100)] + [(None, 1), (5, None)], "doc_id long, toxic int")
    texts = [(i, f"the garden w{i} {'idiot' if i % 2 else 'house'} w{i + 1} grows") for i in range(100)]
    machine = toxicity.train(spark.createDataFrame(texts, "doc_id long, text string"), labels)
    got = toxicity.score(frame, machine)
    assert got.count() == len(rows) and got.where("score is null or score < 0 or score > 1").count() == 0
    found = toxicity.score(spark.createDataFrame(texts, "doc_id long, text string"), machine).where("predicted = 1")
    assert [r["doc_id"] % 2 for r in found.collect()] == [1] * 50
    kept = toxicity.without_toxic(frame, machine)
    assert kept.columns == frame.columns and kept.count() == got.where("predicted = 0").count()
    assert toxicity.score(none, machine).count() == 0
    empty = toxicity.train(none, labels)
    assert toxicity.score(frame, empty).where("score <> 0").count() == 0 and toxicity.without_toxic(frame, empty).count() == len(rows)


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    got = queries.QUERIES["op2_toxicity"](spark, sf)
    labels = spark.read.parquet(f"{sf}/labels.parquet").where("toxic is not null")
    held = got.where("held_out").join(labels, "doc_id").select("score", "toxic").toPandas()
    bad, good = held.score[held.toxic == 1].to_numpy(), held.score[held.toxic == 0].to_numpy()
    assert (bad[:, None] > good).mean() + 0.5 * (bad[:, None] == good).mean() > 0.8
    assert ((held.score >= 0.7) == (held.toxic == 1)).mean() > 0.9


def test_token_counts(case, none, tmp_path):
    rows, frame = case
    cache = str(tmp_path / "cache")
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = []
    for doc_id, text in rows:
        n = len(tokenizer.encode(text or "", add_special_tokens=False).ids)
        want.append((doc_id, len((text or "").encode()), n, n > 2048))
    assert sorted_rows(token_counts.count_tokens(frame, cache), "doc_id", "n_bytes", "n_tokens", "over_limit") == sorted(want, key=repr)
    spark = frame.sparkSession
    before = spark.read.parquet(cache).count()
    assert before == spark.read.parquet(cache).select("content").distinct().count()
    assert sorted_rows(token_counts.count_tokens(frame, cache), "doc_id", "n_tokens") == sorted([(w[0], w[2]) for w in want], key=repr)
    assert spark.read.parquet(cache).count() == before  # nothing was encoded again
    assert token_counts.count_tokens(none, cache).count() == 0


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "piece_bpe_32k.model"])
def test_token_counts_of_whole_texts(odd, name, tmp_path):
    rows, frame = odd
    path = public_tokenizers.path(name)
    got = token_counts.count_tokens(frame, str(tmp_path / "cache"), path, by_word=False)
    texts = [text or "" for _, text in rows]
    counts = token_counts.counter(path, False).counts([t.encode() for t in texts])
    if name.endswith(".json"):
        assert counts == [len(e.ids) for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]
    assert sorted_rows(got, "doc_id", "n_tokens") == sorted(((i, n) for (i, _), n in zip(rows, counts)), key=repr)


def test_packing(case, none):
    rows, frame = case
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    packed = packing.pack_documents(frame)
    got = packed.toPandas()
    want = sorted(tuple(tokenizer.encode(text or "", add_special_tokens=False).ids + [0]) for _, text in rows)
    assert sorted(sum((list(x) for x in got.ids), [])) == sorted(sum((list(x) for x in want), []))
    for ids, crc, length in zip(got.ids, got.ids_crc32, got.length):
        assert zlib.crc32(np.array(ids, "<u4").tobytes()) == crc and len(ids) == length <= 2048
    whole = got[got.length < 2048]
    assert (whole.start[whole.piece == 0] == 0).all() and (got.length[got.piece > 0] == 2048).all()
    ends = got.sort_values(["sequence_id", "offset"]).groupby("sequence_id")
    assert all((g.offset == g.length.cumsum() - g.length).all() and g.length.sum() <= 2048 for _, g in ends)
    assert got.sequence_id.nunique() <= -(-got.length.sum() // 2048) + max(1, len(rows) // 100)
    assert {r["sequence_id"]: len(r["ids"]) for r in packing.sequences(packed).collect()} == ends.length.sum().to_dict()
    assert packing.pack_documents(none).count() == 0


def test_best_two_fit_places_every_piece_once():
    pick = np.random.default_rng(0)
    for capacity, n in ((10, 50), (100, 3000), (64, 1)):
        lengths = pick.integers(1, capacity + 1, n)
        runs = packing.best_two_fit(np.bincount(lengths, minlength=capacity + 1), capacity)
        placed, ends = [], {}
        for length, first, each, times, sequence, offset in runs:
            for i in range(each * times):
                placed.append((length, first + i))
                ends.setdefault(sequence + i // each, []).append((offset + i % each * length, length))
        assert len(placed) == len(set(placed)) == n and sorted(x[0] for x in placed) == sorted(lengths)
        for own in ends.values():
            at = 0
            for offset, length in sorted(own):
                assert offset == at
                at += length
            assert at <= capacity
        assert len(ends) <= lengths.sum() / capacity * 1.12 + 2


def test_replaces_the_smallest_by_two_that_fit_better():
    lengths = [6, 3, 2, 2]
    runs = packing.best_two_fit(np.bincount(lengths, minlength=11), 10)
    assert {(length, sequence) for length, _, _, _, sequence, _ in runs} == {(6, 0), (2, 0), (3, 1)}


def test_chat(spark, none):
    rows = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]"), (1, 2, "assistant", "\\<s>\\"),
            (1, 0, None, None), (1, 1, "sys\ntem", "[TEXT]"), (1, 1, "sys\ntem", "[TEXT]"), (None, 0, "user", "x"), (2, None, "tool", ""),
            (3, 0, "assistant", ""), (3, 1, "assistant", "é👍")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("formatted", F.lit(1))
    got = {r["conv_id"]: r for r in chat.format_conversations(frame, outputs=tuple(chat.OUTPUTS)).collect()}
    assert set(got) == {-7, 1, 2, 3, None}
    for conv, row in got.items():
        own = sorted((r[1:] for r in rows if r[0] == conv), key=lambda r: (r[0] is not None, r[0], r[1] or "", r[2] or ""))
        turns = [(role or "", text or "") for _, role, text in own]
        assert chat.read_back(row["formatted"]) == turns and row["n_turns"] == len(turns)
        assert row["turns_sha256"] == brute.sha("".join(f"{r}\n{t}\n" for r, t in turns))
        said = "".join(t for r, t in turns if r == "assistant")
        assert (row["loss_chars"], row["loss_sha256"]) == (len(said), brute.sha(said))
        assert row["formatted_chars"] == len(row["formatted"])
    assert chat.format_conversations(frame.limit(0)).count() == 0


def test_templates():
    render = chat.compile_template("{% if a == 'x' and not b %}{{ a ~ '!' | upper }}{% elif b %}B{% else %}{{ items[1].k }}{% endif %}")
    assert render(a="x", b=False, items=[])[0] == "x!" and render(a="", b=True, items=[])[0] == "B"
    assert render(a="", b=False, items=[{}, {"k": 5}])[0] == "5"
    loop = chat.compile_template("{% for x in xs %}{{ loop.index }}{% generation %}{{ x }}{% endgeneration %}{% endfor %}")
    assert loop(xs=["ab", "c"]) == ("1ab2c", [(1, 3), (4, 5)])
    assert chat.fold(chat.parse("a{{ 'b' ~ 1 }}{% if true %}c{% else %}d{% endif %}")) == [("text", "ab1c")]
    for bad in ("{{ x.__class__() }}", "{% if a %}", "{{ open('x') }}", "{{ a | eval }}", "{% import os %}", "{{ 1 + }}"):
        with pytest.raises(chat.TemplateError):
            chat.parse(bad)
    with pytest.raises(chat.TemplateError):
        chat.compile_template("{{ x.__class__ }}")(x="a")


def test_exact_dedup(case, none):
    rows, frame = case
    for size in (exact_dedup.BLOCK, 16):
        got = exact_dedup.exact_duplicates(frame, size=size)
        want = [(doc_id, *own) for (doc_id, _), own in zip(rows, brute.exact(rows))]
        assert sorted_rows(got, "doc_id", "keep_id", "group_size", "text_sha256") == sorted(want, key=repr)
        assert got.where("kept").count() == len({w[3] for w in want})
        assert got.where("kept and not (doc_id <=> keep_id)").count() == 0
    kept = exact_dedup.drop_duplicates(frame)
    assert kept.columns == frame.columns and kept.count() == len({w[3] for w in want})
    assert exact_dedup.exact_duplicates(none).count() == 0


def test_byte_bpe(case, none):
    rows, frame = case
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    library = tiktoken.Encoding("test", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = bpe.transcode(frame, outputs=tuple(bpe.OUTPUTS))
    want = []
    for doc_id, text in rows:
        ids = library.encode_ordinary(text or "")
        want.append((doc_id, ids, len(ids), brute.sha(",".join(map(str, ids))), brute.sha(text or "")))
    assert sorted_rows(got, "doc_id", "ids", "n_tokens", "ids_sha256", "decoded_sha256") == sorted(want, key=repr)
    assert sorted(bytes(r["decoded"]) for r in got.collect()) == sorted((t or "").encode() for _, t in rows)
    assert bpe.transcode(none).count() == 0


def test_bpe_pairs_are_those_of_the_merges():
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    codec, pick = bpe.Codec(ranks, public_tokenizers.PATTERN), random.Random(0)
    common_ids = sorted(codec.entries)[:2500]
    for _ in range(5000):
        a, b = pick.choice(common_ids), pick.choice(common_ids)
        assert codec.pairs[a, b] == (bpe.merged(codec.entries[a] + codec.entries[b], ranks) == [codec.entries[a], codec.entries[b]])
    assert codec.encode_piece(b"") == [] and codec.encode("") == []
    with pytest.raises(ValueError):
        bpe.Codec({b"a": 0}, ".")


@pytest.mark.parametrize("order", [1, 2, 3])
def test_language_model(case, none, order):
    rows, frame = case
    held = toxicity.fold_of(F.col("doc_id"), 10) == 0
    got = lm.score_texts(frame, held, order=order, mass=5.0, block=3000)
    want = brute.language_model(rows, 5.0, order)
    found = sorted_rows(got, "doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score")
    expected = sorted(((i, *own) for (i, _), own in zip(rows, want)), key=repr)
    found, expected = (sorted(x, key=lambda r: (str(r[0]), r[1], round(r[4], 3))) for x in (found, expected))
    assert [r[:4] for r in found] == [r[:4] for r in expected]
    assert np.allclose([r[4:] for r in found], [r[4:] for r in expected], atol=1e-6)
    assert lm.score_texts(none, held).count() == 0
    nothing = lm.score_texts(frame, F.lit(True)).collect()
    assert all(r["train_tokens"] == r["n_known"] == 0 for r in nothing)


def vectors():
    pick = np.random.default_rng(2)
    base = pick.normal(size=(40, 16))
    near = np.repeat(base[:10], 6, 0) + 0.03 * pick.normal(size=(60, 16))
    rows = [[float(np.float32(x)) for x in v] for v in np.concatenate([base, near, base[:5], base[:5]])]
    rows += [None, [], [0.0] * 16, [float("nan")] * 16, [float("inf")] + [1.0] * 15, [None] + [1.0] * 15, [1.0, 2.0], [2.0, 4.0], [-1.0, 2.0]]
    return rows


@pytest.mark.parametrize("chunk", [vector_dedup.CHUNK, 3])
def test_vectors(spark, chunk, monkeypatch):
    monkeypatch.setattr(vector_dedup, "CHUNK", chunk)
    monkeypatch.setattr(vector_dedup, "SALT", 4 * chunk)
    monkeypatch.setattr(vector_dedup, "PER_LIST", 8)
    rows, pairs = vectors(), []
    unit = [None if not v or None in v or not np.isfinite(v).all() or not any(v) else np.array(v) / np.linalg.norm(v) for v in rows]
    for i, a in enumerate(unit):
        for j in range(i):
            if a is not None and unit[j] is not None and len(a) == len(unit[j]) and a @ unit[j] >= 0.95:
                pairs.append((i, j))
    group, degree = brute.closure(len(rows), pairs), np.bincount(np.array(pairs).ravel(), minlength=len(rows))
    frame = spark.createDataFrame(list(enumerate(rows)), "vec_id long, embedding array<float>").withColumn("node", F.lit(1))
    for spread in (None, vector_dedup.SPREAD):
        got = vector_dedup.near_vectors(frame, spread=spread)
        assert sorted_rows(got, "vec_id", "n_links", "component_id", "kept") == sorted(
            ((i, int(degree[i]), g, g == i) for i, g in enumerate(group)), key=repr)
    assert vector_dedup.near_vectors(frame.limit(0)).count() == 0
    assert vector_dedup.near_vectors(frame.withColumn("vec_id", F.lit(None).cast("long"))).where("n_links <> 0").count() == 0


def test_vector_recall(spark):
    """Planted neighbours just above the threshold, among vectors that point everywhere."""
    pick = np.random.default_rng(7)
    base = pick.normal(size=(3000, 64))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    side = pick.normal(size=base.shape)
    side -= (side * base).sum(1, keepdims=True) * base
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    near = 0.955 * base[:1000] + np.sqrt(1 - 0.955**2) * side[:1000]
    both = np.concatenate([base, near])
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(both)], "vec_id long, embedding array<double>")
    cosines = both @ both.T
    want = int((cosines >= 0.95).sum()) - len(both)
    got = vector_dedup.near_vectors(frame).agg(F.sum("n_links")).first()[0]
    assert 0.99 * want <= got <= want


def test_substring_dedup(case, none):
    rows, frame = case
    got = substring_dedup.repeated_passages(frame)
    want = brute.without_repeats([text for _, text in rows])
    assert sorted_rows(got, "key", "n_words", "n_removed", "kept_sha256") == sorted(
        ((i, n, gone, brute.sha(kept)) for (i, _), (n, gone, kept) in zip(rows, want)), key=repr)
    cut = substring_dedup.cut_passages(frame)
    assert cut.columns == frame.columns
    left = [(i, kept.decode() if gone else text) for (i, text), (_, gone, kept) in zip(rows, want)]
    assert sorted_rows(cut, "doc_id", "text") == sorted(left, key=repr)
    assert substring_dedup.repeated_passages(none).count() == 0


@pytest.mark.parametrize("words", [["la"] * 40, ["la", "le"] * 20, ["la"] * 36, ["la"] * 35])
def test_a_passage_that_repeats_only_itself(spark, words):
    text = " ".join(words)
    (n, gone, kept), = brute.without_repeats([text])
    got = substring_dedup.repeated_passages(spark.createDataFrame([(1, text)], "doc_id long, text string"))
    assert sorted_rows(got, "n_words", "n_removed", "kept_sha256") == [(n, gone, brute.sha(kept))]
    assert gone == (len(words) if len(words) > 35 else 0)


@pytest.mark.parametrize("crowded", [0, 3])
def test_crowded_anchors_go_by_window(small, crowded, monkeypatch):
    monkeypatch.setattr(substring_dedup, "CROWDED", crowded)
    monkeypatch.setattr(substring_dedup, "SHARD_WORDS", 500)
    rows, frame = small
    want = brute.without_repeats([text for _, text in rows], 12)
    got = substring_dedup.repeated_passages(frame, window=12, anchor=5)
    assert sorted_rows(got, "key", "n_removed") == sorted(((i, w[1]) for (i, _), w in zip(rows, want)), key=repr)


def test_a_passage_of_many_texts_is_never_in_one_index(spark, monkeypatch):
    """Its windows are counted by Spark; an index holds a shard's words and the segments of one uncrowded anchor more at most."""
    pick = np.random.default_rng(3)
    passage = " ".join(f"p{i}" for i in range(16))
    around = [[" ".join(f"w{x}" for x in pick.integers(0, 10**6, 15)) for _ in range(2)] for _ in range(200)]
    rows = [(i, f"{before} {passage} {after}") for i, (before, after) in enumerate(around)]
    most = 500 + 5 * 100

    class Bounded(fm_index.FMIndex):
        def __init__(self, text, size):
            assert len(text) <= most, f"{len(text)} words in one index"
            fm_index.FMIndex.__init__(self, text, size)

    monkeypatch.setattr(substring_dedup, "CROWDED", 5)
    monkeypatch.setattr(substring_dedup, "SHARD_WORDS", 500)
    monkeypatch.setattr(substring_dedup, "FMIndex", Bounded)
    got = substring_dedup.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string"), window=12, anchor=5)
    want = brute.without_repeats([text for _, text in rows], 12)
    assert sorted_rows(got, "key", "n_removed", "kept_sha256") == sorted(
        ((i, gone, brute.sha(kept)) for i, (_, gone, kept) in enumerate(want)), key=repr)
    assert {gone for _, gone, _ in want} == {16}


def test_texts_are_split_in_pieces_of_bounded_size():
    texts = [b"a b " * 75_000] * 5 + [b"c"] * 1000 + [b"d " * 2_000_000]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts, pa.binary())], names=["row", "text"]).slice(1)
    pieces = list(substring_dedup._pieces(batch, 1))
    assert [i for piece in pieces for i in piece.column(0).to_pylist()] == list(range(1, len(texts)))
    assert all(p.num_rows == 1 or p.num_rows <= 400 and sum(map(len, p.column(1).to_pylist())) <= 1 << 20 for p in pieces)


def test_fm_index_counts_what_is_there():
    pick = np.random.default_rng(0)
    strings = [pick.integers(1, 5, pick.integers(1, 60)) for _ in range(30)]
    text = np.concatenate([np.append(s, 0) for s in strings])
    index = fm_index.FMIndex(text, 5)
    joined = " ".join(map(str, text))
    for _ in range(300):
        own = strings[pick.integers(len(strings))]
        begin = pick.integers(len(own))
        pattern = own[begin : begin + pick.integers(1, 8)]
        low, high = np.array([0]), np.array([index.length])
        for symbol in pattern[::-1]:
            low, high = index.step(np.array([symbol]), low, high)
        wanted = " ".join(map(str, pattern))
        assert high[0] - low[0] == sum(joined.startswith(wanted, i) for i in range(0, len(joined), 2))


def test_components(spark):
    pick = random.Random(4)
    pairs = [(i, i + 1) for i in range(0, 60)] + [(pick.randrange(100, 200), pick.randrange(100, 200)) for _ in range(60)]
    pairs = [(a, b) for a, b in pairs if a != b]
    pick.shuffle(pairs)
    root = brute.closure(200, pairs)
    got = common.components(spark.createDataFrame(pairs, "a long, b long"))
    linked = {x for pair in pairs for x in pair}
    assert sorted(tuple(r) for r in got.groupBy("node").agg(F.min("root")).collect()) == sorted((i, root[i]) for i in linked)


def test_pipeline(spark, small):
    """Each stage against a plain version of it on what its predecessor kept."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r for r in docs.collect()}
        docs = common.staged(stage(spark, docs, SF), "test")
        kept[name] = (before, docs.collect())
        if name != "best_fit_packing":
            assert docs.columns == columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "ngram_jaccard_join", "substring_dedup",
                                                      "best_fit_packing"]
    before, after = kept["toxicity"]
    assert 0.7 * len(before) < len(after) <= len(before)
    before, after = kept["exact_dedup"]
    rows = [(i, r["text"]) for i, r in before.items()]
    assert {r["doc_id"] for r in after} == {keep for keep, _, _ in brute.exact(rows)}
    before, after = kept["ngram_jaccard_join"]
    rows = sorted((i, r["text"]) for i, r in before.items())
    _, group = brute.jaccard_links([t for _, t in rows])
    assert {r["doc_id"] for r in after} == {rows[g][0] for g in group}
    before, after = kept["substring_dedup"]
    rows = [(i, r["text"]) for i, r in before.items()]
    want = {i: kept.decode() if gone else t for (i, t), (_, gone, kept) in zip(rows, brute.without_repeats([t for _, t in rows]))}
    assert {r["doc_id"]: r["text"] for r in after} == want and all(r["n_chars"] == len(r["text"]) for r in after)
    before, after = kept["best_fit_packing"]
    assert {r["doc_id"] for r in after} == set(before)
    assert {n for n in queries.QUERIES if n.startswith("op")} | {"pipeline"} == set(queries.QUERIES) and len(queries.QUERIES) == 11


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_matches_sql(spark, name):
    from compare import connect, difference, duck_rows, spark_rows

    got = spark_rows(queries.QUERIES[name](spark, SF))
    assert difference(got, duck_rows(connect(SF), queries.ORACLES[name])) is None


def test_rows_of_one_key_do_not_meet_each_other(spark):
    """Many rows without a key: the join back to the texts stays linear, and links are found."""
    base = [f"w{i}" for i in range(60)]
    rows = [(None, " ".join([*base[:59], f"x{i}"])) for i in range(400)] + [(None, " ".join(base))] * 50
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    degree, group = brute.jaccard_links([text for _, text in rows])
    got = ngram_join.near_duplicates(frame)
    assert sorted(r["n_links"] for r in got.collect()) == sorted(degree)
    assert got.where("kept").count() == len(set(group))
    made = []
    real = ngram_join._with_sets

    def counted(texts, words):
        made.append(texts.count())
        return real(texts, words)

    ngram_join._with_sets = counted
    try:
        ngram_join.near_duplicates(frame)
    finally:
        ngram_join._with_sets = real
    assert made and made[0] <= len(rows)


@pytest.mark.parametrize("partitions", [1, 5])
def test_the_smallest_key_stays_in_tables_with_null_and_repeated_keys(spark, partitions):
    """Ties go by key, not by the order of the rows, also where some other key is null or repeats."""
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(None, "unrelated"), (9, "also unrelated"), (9, "and another one"), (7, ""), (3, None), (5, text), (2, text), (None, text),
            (8, text + " more"), (4, text + " else")]
    for order in (rows, rows[::-1]):
        frame = spark.createDataFrame(order, "doc_id long, text string").repartition(partitions)
        kept = exact_dedup.drop_duplicates(frame)
        assert sorted((r["doc_id"] for r in kept.collect()), key=repr) == [2, 3, 4, 8, 9, 9, None]
        near = ngram_join.drop_near_duplicates(kept)
        assert sorted((r["doc_id"] for r in near.collect()), key=repr) == [2, 3, 9, 9, None]
        assert substring_dedup.cut_passages(near).count() == 5


def test_different_vectors_may_share_a_key(spark):
    rows = [(1, [1.0, 0.0, 0.0, 0.0]), (1, [0.999, 0.04, 0.0, 0.0]), (2, [0.0, 1.0, 0.0, 0.0]), (2, [0.0, 0.0, 1.0, 0.0]),
            (0, [0.0, 0.0, 0.999, 0.03]), (None, [1.0, 0.0, 0.0, 0.0])]
    got = vector_dedup.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(
        [(1, 1, 1, True), (1, 1, 1, True), (2, 0, 2, True), (2, 1, 0, False), (0, 1, 0, True), (None, 0, None, True)], key=repr)
