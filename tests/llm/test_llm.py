"""The corpus operators against short plain models, and on odd rows."""

import random
import zlib
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from docengine.llm import blocks, lines, minhash_join, mixing, packing, quality, suffixes, syncmers
from docengine.llm import secrets, url_lists, vectors
from docengine.llm import queries
from docengine.llm.components import components
from docengine.sources.workspace import RunFolder

def united(nodes, links):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def test_near_copies_match_all_pairs(spark):
    random = np.random.default_rng(1)
    rows = []
    for group in range(6):
        words = [f"g{group}w{k}" for k in range(120)]
        for copy in range(8):
            text = [w if random.random() > 0.012 * copy else f"e{random.integers(1e9)}" for w in words]
            rows.append((len(rows), " ".join(text)))
    sets = {i: minhash_join.shingles(t, 2) for i, t in rows}
    links = [
        (a, b)
        for a, b in combinations(sets, 2)
        if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    ]
    expected = united(sets, links)
    got = minhash_join.near_copies(spark.createDataFrame(rows, "doc_id long, text string"), words=2)
    assert {r["doc_id"]: r["component_id"] for r in got.collect()} == expected


def test_near_copies_of_odd_rows(odd):
    got = minhash_join.near_copies(odd).collect()
    assert len(got) == 9
    by = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in got}
    assert by[2][1:] == (1, False) and by[3] == (0, 3, True) and by[6] == (1, 6, True)
    assert by[None][1:] == (None, True)


def test_lines_of_odd_rows(odd):
    got = lines.line_verdicts(odd)
    stay = {(r["doc_id"], r["line_no"]): r["kept"] for r in got.collect()}
    assert stay[1, 0] and not stay[2, 0] and stay[7, 1] and not stay[7, 2]
    left = lines.without_repeats(odd)
    assert left.schema == odd.schema
    texts = {r["doc_id"]: r["text"] for r in left.collect()}
    assert 2 not in texts and texts[7] == "ÄÖ 漢字\nline\n" and texts[4] == "" and texts[3] is None


def line_links(given):
    sets = [lines.shingle_set(x) for x in given]
    return [
        (a, b)
        for a, b in combinations(range(len(sets)), 2)
        if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    ]


def test_block_comparison_takes_every_pair_that_shares_a_band(spark, tmp_path, monkeypatch):
    """Pairs that agree in a band, but in none of the first six bins."""
    random = np.random.default_rng(5)
    found = []
    while len(found) < 20:
        x = "".join(random.choice(list("abcdefghij"), 15))
        y = x + "abcdefghij"[random.integers(10)]  # 8 and 9 shingles
        bins = lines.bin_minima([x, y])
        keys = lines.band_keys(bins)
        if (keys[0] == keys[1]).any() and not (bins[0, :6] == bins[1, :6]).any():
            found.append((x, y))
    asked = []

    def finish_all(members, confirm, finish, run, name):
        ids = members.groupBy("id").count().select("id", F.col("id").alias("part"))
        asked.append(finish(run.write(ids, "all"), "all").count())
        return confirm(members.select(F.col("id").alias("a"), F.col("id").alias("b")).limit(0), "no").toDF("id", "component")

    monkeypatch.setattr(lines, "bucket_components", finish_all)
    rows = [(k, "\n".join(pair)) for k, pair in enumerate(found)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    lines.line_verdicts(df, folder=str(tmp_path / "run")).count()
    assert asked == [len(line_links([x for pair in found for x in pair]))] and asked[0] >= 20


def test_short_lines_match_all_pairs(spark):
    """Pairs that agree in few of 30 bins or in none of 10 bands, and others."""
    random = np.random.default_rng(6)
    given, odd = [], 0
    for k in range(6000):
        x = "".join(random.choice(list("abcdefghijklmnop"), 11 + 4 * (k % 3)))
        y = x + "".join(random.choice(list("abcdefghijklmnop"), (len(x) - 7) // 4))
        bins = lines.bin_minima([x, y])
        keys = lines.band_keys(bins)
        few = (bins[0] == bins[1]).sum() < 12 or not (keys[0] == keys[1]).any()
        odd += few
        if few or k < 300:
            given += [x, y]
    expected = united(range(len(given)), line_links(given))
    df = spark.createDataFrame(list(enumerate(given)), "doc_id long, text string")
    got = {r["doc_id"]: r["group_doc_id"] for r in lines.line_verdicts(df).collect()}
    assert odd >= 20 and got == expected


def test_vectors_match_all_pairs(spark):
    random = np.random.default_rng(2)
    base = random.standard_normal((20, 16))
    many = [base[k % 20] + 0.04 * random.standard_normal(16) for k in range(200)]
    rows = [(k, [float(np.float32(x)) for x in v], k % 3) for k, v in enumerate(many)]
    rows += [(300, rows[0][1], 0), (301, None, 0), (302, [0.0] * 16, 0), (303, [1.0, None], 0)]
    rows += [(304, [float("nan")] * 16, 0), (305, rows[0][1], None), (306, [2.0], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    unit = {i: np.array(v, float) / np.linalg.norm(v) for i, v, l in rows[:201]}
    links = [
        (a, b)
        for (a, _, x), (b, _, y) in combinations(rows[:201], 2)
        if x == y and unit[a] @ unit[b] >= 0.98
    ]
    expected = united([r[0] for r in rows], links)
    got = {r["vec_id"]: r for r in vectors.near_vectors(df).collect()}
    assert {i: r["component_id"] for i, r in got.items()} == expected
    count = {i: sum(i in link for link in links) for i in expected}
    assert {i: r["n_links"] for i, r in got.items()} == count


@pytest.mark.parametrize("seed", range(5))
def test_packing_fills_sequences(seed):
    random = np.random.default_rng(seed)
    sizes = random.integers(1, 1024, 300).tolist()
    found = packing.pack(sizes)
    parts = sorted(p for s in found for p in s)
    for item, size in enumerate(sizes):
        own = [(a, n) for i, a, n in parts if i == item]
        assert sum(n for _, n in own) == size and own[0][0] == 0
        assert all(a + n == b for (a, n), (b, _) in zip(own, own[1:]))
    totals = [sum(p[2] for p in s) for s in found]
    assert all(t & (t - 1) == 0 and t <= 1024 for t in totals) and sum(t < 1024 for t in totals) <= 10


def test_first_fit_decreasing_takes_the_first_bin_with_room():
    assert packing.first_fit_decreasing([500, 600, 400, 524], 1024) == [[1, 2], [3, 0]]


def test_packed_ids_are_those_of_the_vocabulary(odd):
    from public_tokenizers import path
    from tokenizers import Tokenizer

    exact = Tokenizer.from_file(path("byte_bpe_50k.json"))
    texts = {r["doc_id"]: r["text"] or "" for r in odd.collect()}
    for r in packing.packed(odd).collect():
        ids = np.array([*exact.encode(texts[r["doc_id"]], add_special_tokens=False).ids, 0], "<u4")
        piece = ids[r["start"] : r["start"] + r["length"]]
        assert len(ids) == r["doc_tokens"] and zlib.crc32(piece) == r["ids_crc32"]


def test_both_encoders_agree():
    from public_tokenizers import path
    from tokenizers import Tokenizer

    exact = Tokenizer.from_file(path("byte_bpe_50k.json"))
    encode = packing.encoder(path("byte_bpe_50k.json"), path("byte_bpe_50k.tiktoken"))
    letters = "aé ß\n\t\r\x1c\x85\xa0'sZ09.,!ʼnɏ"
    random = np.random.default_rng(3)
    for _ in range(2000):
        text = "".join(random.choice(list(letters), 12))
        assert encode(text) == exact.encode(text, add_special_tokens=False).ids
    assert encode("<|endoftext|>漢") == exact.encode("<|endoftext|>漢", add_special_tokens=False).ids


def test_mix_takes_the_targets(odd):
    rows = mixing.mix(odd).collect()
    assert len(rows) == 9 and all(r["taken"] <= 3 * r["size"] for r in rows)
    taken = {}
    for r in rows:
        taken.setdefault((r["source"], r["target"]), []).append(r["taken"])
    assert all(abs(sum(t) - target) <= 1 for (_, target), t in taken.items())
    out = mixing.mixed(odd)
    assert out.columns == odd.columns
    assert sum(len((r["text"] or "").split()) for r in out.collect()) == sum(r["taken"] for r in rows)


def test_mix_moves_only_documents_of_the_cut(spark):
    docs = [(k, "w " * (k % 40), f"s{k % 4}" if k % 4 else None) for k in range(2000)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string").repartition(3)
    names = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")
    before = [spark.conf.get(n) for n in names]
    for name, value in zip(names, ("64", "false")):
        spark.conf.set(name, value)
    try:
        rows = mixing.mix(df).withColumn("at", F.spark_partition_id()).collect()
    finally:
        for name, value in zip(names, before):
            spark.conf.set(name, value)
    # The documents stay in their partitions, but for a range of the hash per source.
    assert len(rows) == 2000 and len({r["at"] for r in rows}) <= 3 + 4
    for source in {r["source"] for r in rows}:
        own = [r for r in rows if r["source"] == source]
        more = [r["taken"] - r["size"] * (r["taken"] // max(1, r["size"])) for r in own]
        assert sum(m > 0 for m in more) <= 1
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= 1


def test_quality_learns_and_handles_odd_rows(spark, odd):
    docs = [(k, ("good words in a row " if k % 2 else "BAD!! BAD!! ") * (3 + k % 7), "en", "s", k) for k in range(400)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(k, k % 2) for k in range(300)], "doc_id long, quality int")
    got = {r["doc_id"]: r["kept"] for r in quality.score(df, labels, limit=0.5).collect()}
    assert all(got[k] == bool(k % 2) for k in range(300, 400))
    few = labels.where("doc_id < 3")  # too few to hold any out
    assert len({r["score"] for r in quality.score(df, few).collect()}) > 1
    assert quality.good(odd, labels.limit(0)).count() == 9
    assert quality.good(odd, labels).schema == odd.schema


def test_fingerprints_of_odd_rows(odd):
    rows = {(r["doc_id"], r["n_chars"]): r for r in syncmers.fingerprints(odd).collect()}
    assert rows[3, 0]["fingerprint"] == "" and rows[3, 0]["near_next"] >= 0
    assert 0 < rows[2, len("".join([r["text"] for r in odd.where("doc_id = 2").collect()]))]["near_edited"] < 1


def test_passages_match_all_windows(spark):
    words = [f"w{k}" for k in range(500)]
    rows = [(1, " ".join(words[:200])), (2, "a b " + " ".join(words[50:105]) + " c"),
            (3, " ".join(words[300:340])), (4, " ".join(words[300:345])), (5, None), (None, "x")]
    got = suffixes.passages(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {tuple(r) for r in got.collect()} == {(1, 50, 55), (2, 2, 55)}


def test_passages_of_edited_copies_match_all_windows(spark):
    rng = np.random.default_rng(3)
    base = [f"w{k}" for k in rng.integers(0, 40, 400)]
    rows = []
    for doc in range(30):
        words = base[rng.integers(0, 60) : 400 - rng.integers(0, 60)]
        for at in rng.integers(0, len(words), 5):
            words[at] = f"e{doc}"
        rows.append((doc, " ".join(words)))
    rows += [(30, "a " * 130), (30, "b " * 49), (31, None), (7, rows[7][1])]
    seen = {}
    for doc, text in rows:
        words = (text or "").split()
        for at in range(len(words) - 49):
            seen.setdefault(tuple(words[at : at + 50]), []).append((doc, at))
    covered = {(doc, at + k) for places in seen.values() if len(places) > 1 for doc, at in places for k in range(50)}
    got = suffixes.passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r["doc_id"], r["start"] + k) for r in got for k in range(r["n_words"])} == covered


def test_secrets_learn_from_findings(spark):
    rows = [(k, f"so password=ab{k:04d}cdef{k:04d}99 and 10.0.{k}.123456 here", "s") for k in range(60)]
    df = spark.createDataFrame([*rows, (99, None, None)], "doc_id long, text string, source string")
    labelled = secrets.findings(df.where("doc_id < 40"), []).select(
        "doc_id", "word_no", F.col("candidate").startswith("password").cast("int").alias("secret")
    )
    got = secrets.scan(df, labelled, ["here"]).collect()
    assert len(got) == 120 and all(r["is_secret"] == r["candidate"].startswith("password") for r in got)


def test_urls_are_judged_as_of_their_time(spark):
    entries = spark.createDataFrame(
        [("bad.org", "block", "2024-01-10"), ("bad.org", "allow", "2024-03-10"),
         ("ok.bad.org/x", "allow", "2024-01-01"), (None, "block", "2024-01-01")],
        "entry_key string, action string, since string",
    ).withColumn("since", F.to_timestamp("since"))
    captures = spark.createDataFrame(
        [(1, "http://a.bad.org/q", "2024-01-09"), (2, "http://a.bad.org/q", "2024-02-09"),
         (3, "http://a.bad.org/q", "2024-03-11"), (4, "http://OK.bad.org/x/y", "2024-02-09"),
         (5, None, "2024-02-09"), (6, "http://a.bad.org/", None), (2, "http://a.bad.org/q", "2024-02-09")],
        "capture_id long, url string, fetched string",
    ).withColumn("fetched", F.to_timestamp("fetched"))
    got = sorted((r["capture_id"], r["blocked"]) for r in url_lists.judge(captures, entries).collect())
    assert got == [(1, False), (2, True), (2, True), (3, False), (4, False), (5, False), (6, False)]


def test_passages_of_odd_rows(odd):
    got = suffixes.passages(odd).collect()
    assert sorted(tuple(r) for r in got) == [(1, 0, 400), (2, 0, 400)]


def test_secrets_are_found_anywhere_in_a_text(spark):
    key = "04dbebab91ab85687d33eeaaf9ac699e1188f962"
    texts = {
        f'so token = "{key}"### end': (1, f'token = "{key}"', "so", "###"),
        f"{key}, it is": (0, key, "", ","),
        f"see ({key[:20]}) now": (1, key[:20], "(", ")"),
        f'TOKEN = "{key.upper()}"!!': (0, f'TOKEN = "{key.upper()}"', "", "!!"),
        'a {"user_id": {"pass_word": "p4 $sw0rd"}} b': (2, 'pass_word": "p4 $sw0rd"', '{"', "}}"),
        "x\ny AWS_SECRET_ACCESS_KEY: 'wJalrXUtnFEMI/K7'; z": (2, "AWS_SECRET_ACCESS_KEY: 'wJalrXUtnFEMI/K7'", "y", ";"),
        "q?token=abcdef12&x=1": (0, "token=abcdef12", "q?", "&x=1"),
        "secret=hunter2hunter, then": (0, "secret=hunter2hunter", "", ","),
        "mail a.b1@mail7.example.com or no number-at-all": None,
    }
    df = spark.createDataFrame(
        [(k, x, "s") for k, x in enumerate(texts)], "doc_id long, text string, source string"
    )
    got = {r["doc_id"]: r for r in secrets.findings(df, []).collect()}
    for k, expected in enumerate(texts.values()):
        if expected is None:
            assert k not in got
        else:
            no, candidate, before, after = expected
            row = got[k]
            assert (row["word_no"], row["candidate"]) == (no, candidate)
            assert (row["before_size"], row["after_size"]) == (len(before), len(after))
    assert [got[k]["size"] for k in (0, 1, 2, 4, 6)] == [40, 40, 20, 9, 8]
    assert got[0]["named"] == got[0]["name_fits"] == 1 and got[1]["named"] == 0
    two = df.limit(1).withColumn("text", F.lit(f'a b="{key}",cd="{key}" x {key}'))
    two = [(r["word_no"], r["candidate"]) for r in secrets.findings(two, []).collect()]
    assert sorted(two) == [(1, key), (1, f'cd="{key}"'), (3, key)]


@pytest.mark.parametrize("size", ["sf0.01", "sf0.1"])
def test_secrets_of_the_given_tables(spark, size):
    folder = f"/root/testdata/{size}"
    got = queries.op7_secrets(spark, folder).select("candidate", "score", "is_secret").collect()
    assert len({r["score"] for r in got}) > 1  # a forest was fitted
    form = r'(?i)token = "[0-9a-f]{40}"'
    texts = spark.read.parquet(f"{folder}/documents.parquet").select(
        F.regexp_extract_all("text", F.lit(form), 0).alias("t")
    )
    planted = sorted(x for r in texts.collect() for x in r["t"] or [])
    assert planted and sorted(r["candidate"] for r in got if r["is_secret"]) == planted


def test_secrets_are_not_judged_without_a_forest(spark):
    df = spark.createDataFrame([(1, "at 10.0.0.123456", "s")], "doc_id long, text string, source string")
    got = secrets.scan(df, secrets.reviewed(df, df.select("doc_id")), []).collect()
    assert [(r["score"], r["is_secret"]) for r in got] == [(0.5, None)]


def test_secrets_of_odd_rows(odd):
    none = secrets.findings(odd, []).select("doc_id", "word_no", F.lit(1).alias("secret")).limit(0)
    assert secrets.scan(odd, none, []).count() == 0
    assert secrets.scan(odd.limit(0), none, []).count() == 0
    plain = odd.where("doc_id = 7").withColumn("text", F.lit("password=ab12cd34ef56ab78 end"))
    got = secrets.scan(plain, none, []).collect()
    assert got and {(r["score"], r["is_secret"]) for r in got} == {(0.5, got[0]["is_secret"])}


def test_near_stage_of_odd_rows(spark, odd):
    kept = corpus_pipeline.near(spark, odd, "")
    assert kept.schema == odd.schema
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(str(i) for i in ids) == ["1", "1", "3", "4", "5", "6", "7", "None"]
    assert corpus_pipeline.near(spark, odd.limit(0), "").count() == 0


def test_no_captures_and_no_list(spark):
    entries = spark.createDataFrame([], "entry_key string, action string, since timestamp")
    rows = [(1, "http://a.b/c", None), (1, "http://a.b/c", None), (2, "", None), (3, None, None)]
    captures = spark.createDataFrame(rows, "capture_id long, url string, fetched timestamp")
    got = url_lists.judge(captures.withColumn("action", F.lit("x")), entries).collect()
    assert sorted((r["capture_id"], r["blocked"]) for r in got) == [
        (1, False), (1, False), (2, False), (3, False)]
    assert url_lists.judge(captures.limit(0), entries).count() == 0


def test_empty_tables(odd, spark):
    none = odd.limit(0)
    assert minhash_join.near_copies(none).count() == 0
    assert lines.without_repeats(none).count() == 0
    assert packing.packed(none).count() == 0
    assert mixing.mixed(none).count() == 0
    assert syncmers.fingerprints(none).count() == 0
    assert suffixes.passages(none).count() == 0
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert vectors.near_vectors(empty).count() == 0


def test_sets_go_only_where_briefs_agree(spark, tmp_path):
    """Of one large list, only items alike in their briefs are taken for comparison."""

    def opened(text):
        if text.startswith("far"):
            raise ValueError("moved for nothing")
        return set(text)

    rows = [(k, k, [7], f"far {k}", [k % 128, k // 128, 1, 2]) for k in range(1500)]
    rows += [(2000, 2000, [7], "abcde", [3, 3, 3, 3]), (2001, 2001, [7, 8], "abcde", [3, 3, 3, 0])]
    rows += [(2002, 2002, [8], "abcde", [4, 4, 4, 0])]
    schema = "id long, part long, coords array<long>, payload string, brief array<tinyint>"
    items = spark.createDataFrame(rows, schema)
    run = RunFolder(spark, str(tmp_path))

    def same(texts):
        sets = [np.array(sorted(map(ord, opened(t)))) for t in texts]
        return np.concatenate(sets), np.concatenate([[0], np.cumsum([len(x) for x in sets])])

    found = blocks.links_between(items, 80, run, "edges", opened, same, least=4)
    assert found.count() == 0
    far = items.where("id >= 2000")
    found = blocks.links_between(far, 80, run, "more", opened, same, least=3)
    assert {frozenset(r) for r in found.collect()} == {frozenset((2000, 2001))}


def test_dissimilar_lines_are_told_apart_without_their_sets(monkeypatch):
    """Pairs that can't be similar build no sets of texts; no similar pair is left out."""
    rng = random.Random(5)
    base = ["".join(rng.choices("abcdefg hi", k=rng.randint(1, 300))) for _ in range(400)]
    near = []
    for x in base:
        chars = list(x)
        for _ in range(rng.randint(0, len(x) // 50 + 1)):
            chars[rng.randrange(len(x))] = rng.choice("xyz")
        near.append("".join(chars))
    xs, ys = base + base + ["a" * 20, "a" * 4000], near + near[1:] + near[:1] + ["a" * 9, "b" * 20]

    def exact(x, y):
        x, y = lines.shingle_set(x), lines.shingle_set(y)
        return 100 * len(x & y) >= 80 * len(x | y)

    def linked(xs, ys):
        columns = [list(range(len(xs))), list(range(len(xs))), xs, ys]
        batch = pa.record_batch([pa.array(c) for c in columns], ["a", "b", "x", "y"])
        return [at for found in lines._similar(80)([batch]) for at in found["a"].to_pylist()]

    expected = [at for at, pair in enumerate(zip(xs, ys)) if exact(*pair)]
    assert linked(xs, ys) == expected and 100 < len(expected) < 700
    made = []
    whole = lines.shingle_set
    monkeypatch.setattr(lines, "shingle_set", lambda x: made.append(x) or whole(x))
    far = [x for x in base if len(x) > 100]
    assert linked(far[:-1], far[1:]) == [] and not made


def test_keys_do_not_depend_on_parts(monkeypatch):
    rng = random.Random(6)
    texts = ["".join(rng.choices("abcdefg hi", k=rng.randint(1, 400))) for _ in range(200)]
    whole = lines.line_keys(texts)
    monkeypatch.setattr(lines, "CACHED", 1000)
    parted = lines.line_keys(texts)
    assert all((a == b).all() for a, b in zip(whole, parted))


def test_shared_keys_are_kept_over_batch_ends():
    """Rows of keys with more than one id, each once, however the batches fall."""
    random = np.random.default_rng(11)
    for _ in range(300):
        rows = sorted(
            (int(k), int(i))
            for k, i in zip(random.integers(0, 6, 25), random.integers(0, 4, 25))
        )
        ids = {}
        for k, i in rows:
            ids.setdefault(k, set()).add(i)
        expected = [(k, i) for k in sorted(ids) for i in sorted(ids[k]) if len(ids[k]) > 1]
        batches, at = [], 0
        while at < len(rows):
            size = int(random.integers(0, 5))
            part = rows[at : at + size]
            batches.append(
                pa.record_batch(
                    [pa.array([r[c] for r in part], pa.int64()) for c in (0, 1)], ["key", "id"]
                )
            )
            at += size
        got = [
            (r["key"], r["id"]) for batch in lines._shared(batches) for r in batch.to_pylist()
        ]
        assert got == expected


def test_keys_meet_in_buckets(monkeypatch):
    """Rows of keys with more than one id, however they are packed, parted and batched."""
    random = np.random.default_rng(14)
    monkeypatch.setattr(lines, "PACKED", 3)
    for posted in (5, 40, 10_000):
        monkeypatch.setattr(lines, "POSTED", posted)
        low = random.integers(0, 2, 400).astype(np.uint64)
        low[:150] = 2  # one key of many rows
        high = random.integers(0, 2**32, 12).astype(np.uint64)[random.integers(0, 12, 400)]
        high[:150] = high[0]
        keys = ((high << np.uint64(32)) | low).view(np.int64)
        ids = random.integers(-9, 9, 400)
        rows = pa.concat_tables(
            pa.Table.from_batches([lines._dealt(keys[a : a + 90], ids[a : a + 90], 4)])
            for a in range(0, 400, 90)
        ).sort_by("bucket")
        assert max(len(x) for x in rows["ids"].to_pylist()) <= 3 * 8
        got = [r for b in lines._meeting(rows.to_batches(7)) for r in b.to_pylist()]
        found, expected = {}, {}
        for r in got:
            found.setdefault(r["key"], set()).add(r["id"])
            assert r["head"] <= r["id"]
        # A bucket tells its keys apart by their lower halves.
        for h, k, i in zip(high, low, ids):
            key = (int(h) * 4 >> 32) << 32 | int(k)
            expected.setdefault(key, set()).add(int(i))
        expected = {k: v for k, v in expected.items() if len(v) > 1}
        assert found == expected
        assert all(r["size"] >= min(3, len(expected[r["key"]])) for r in got)
        if posted == 10_000:
            assert len({(r["key"], r["id"]) for r in got}) == len(got)
            assert all(r["size"] == len(expected[r["key"]]) for r in got)


def test_clear_pairs_are_told_without_their_sets(monkeypatch):
    """Sets of texts are built for pairs close to the limit only."""
    rng = random.Random(7)
    xs = ["".join(rng.choices("abcdefghijklmnopq", k=300)) for _ in range(50)]
    ys = [x[:-3] + "xyz" for x in xs]
    halves = [x[:220] + y[220:] for x, y in zip(xs, xs[1:] + xs[:1])]  # similar at about 0.57
    made = []
    whole = lines.shingle_set
    monkeypatch.setattr(lines, "shingle_set", lambda x: made.append(x) or whole(x))
    columns = [list(range(100)), list(range(100)), xs + xs, ys + halves]
    batch = pa.record_batch([pa.array(c) for c in columns], ["a", "b", "x", "y"])
    got = [at for found in lines._similar(80)([batch]) for at in found["a"].to_pylist()]
    assert got == list(range(50)) and not made


@pytest.mark.parametrize("paired", [2, 128])
def test_leftover_lines_match_all_pairs_by_rows_and_in_blocks(spark, monkeypatch, paired):
    """Chains of copies, whose ends are dissimilar, among many buckets."""
    random = np.random.default_rng(15)
    letters = list("abcdefghijklmnop ")
    given = []
    for _ in range(12):
        y = list("x" + "".join(random.choice(letters, 120)) + "y")
        for at in range(1, 121, 3):
            y[at] = "z"
            given.append("".join(y))
    expected = united(range(len(given)), line_links(given))
    monkeypatch.setattr(lines, "PAIRED", paired)
    monkeypatch.setattr(lines, "BUCKET", 500)
    df = spark.createDataFrame(list(enumerate(given)), "doc_id long, text string")
    got = {r["doc_id"]: r["group_doc_id"] for r in lines.line_verdicts(df).collect()}
    assert got == expected


def test_leftover_lines_of_parted_buckets_match_all_pairs(spark, monkeypatch):
    """Lists whose number is not known, as their bucket was looked at in parts."""
    random = np.random.default_rng(16)
    given = []
    for _ in range(6):
        y = list("x" + "".join(random.choice(list("abcdefghijklmnop "), 120)) + "y")
        for at in range(1, 121, 3):
            y[at] = "z"
            given.append("".join(y))
    expected = united(range(len(given)), line_links(given))
    whole, least = lines._meeting, lines.PAIRED + 1

    def parted(batches):
        for batch in whole(batches):
            size = np.maximum(batch["size"].to_numpy(), least)
            yield pa.record_batch([*batch.columns[:3], pa.array(size)], batch.schema.names)

    monkeypatch.setattr(lines, "_meeting", parted)
    df = spark.createDataFrame(list(enumerate(given)), "doc_id long, text string")
    got = {r["doc_id"]: r["group_doc_id"] for r in lines.line_verdicts(df).collect()}
    assert got == expected


def test_texts_of_dissimilar_lines_are_not_moved(spark, monkeypatch):
    """Lines that share keys, each with half of its text in common with the others of its group."""
    random = np.random.default_rng(17)
    letters = list("abcdefghijklmnopqrstuvwxyz ")
    given = []
    for _ in range(25):
        common = "x" + "".join(random.choice(letters, 150))
        for _ in range(6):
            given.append(common + "".join(random.choice(letters, 150)) + "y")
        given.append(given[-1] + "zz")
    expected = united(range(len(given)), line_links(given))
    keys = [set(lines.line_keys([x])[0].tolist()) for x in given]
    tried = sum(bool(x & y) for x, y in combinations(keys, 2))
    seen, whole = spark.sparkContext.accumulator(0), lines._similar

    def counted(percent):
        run = whole(percent)

        def count(batches):
            for batch in batches:
                seen.add(batch.num_rows)
                yield from run([batch])

        return count

    monkeypatch.setattr(lines, "_similar", counted)
    df = spark.createDataFrame(list(enumerate(given)), "doc_id long, text string")
    got = {r["doc_id"]: r["group_doc_id"] for r in lines.line_verdicts(df).collect()}
    assert got == expected and tried >= 200 and 25 <= seen.value <= 30


def test_marks_tell_no_similar_lines_apart():
    """Marks differ in no more bits than the lines' sets in shingles; pairs of a key meet over batch ends."""
    rng = random.Random(18)
    given = ["".join(rng.choices("abcdé 漢", k=rng.choice([1, 7, 9, 40, 300, 2000]))) for _ in range(60)]
    given = [y for x in given for y in (x, x + "ab")] + ["a" * 500, "ab" * 300]
    sets = [lines.shingle_set(x) for x in given]
    sizes, marks = lines.line_marks(given)
    assert sizes.tolist() == [len(x) for x in sets]
    for a, b in combinations(range(len(given)), 2):
        apart = np.bitwise_count(marks[a].view(np.uint64) ^ marks[b].view(np.uint64)).sum()
        assert apart <= len(sets[a] ^ sets[b])
    key, part = np.arange(len(given)) // 7, np.arange(len(given)) % 3
    columns = [key, np.arange(len(given)), part, sizes, *marks.T]
    table = pa.record_batch([pa.array(c) for c in columns], ["v", "id", "part", "size", *lines.MARKS])
    cuts = [0, 1, 1, 5, 40, 41, 90, len(given)]
    batches = [table.slice(a, b - a) for a, b in zip(cuts, cuts[1:])]
    got = [tuple(r.values()) for b in lines._meant(80)(batches) for r in b.to_pylist()]
    like = {
        (a, b) for a, b in combinations(range(len(given)), 2)
        if key[a] == key[b] and part[a] != part[b]
        and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    }
    assert like and like <= set(got) and len(set(got)) == len(got) < len(given)


def test_long_lines_match_all_pairs(spark):
    """Lines of 60 to 300 characters, edited so that similarities lie around the limit."""
    random = np.random.default_rng(12)
    letters = list("abcdefghijklmnop ")
    given = []
    for k in range(120):
        x = "x" + "".join(random.choice(letters, 60 + 2 * k)) + "y"
        for edits in range(4):
            y = list(x)
            for at in random.integers(1, len(x) - 1, edits):
                y[at] = random.choice(letters)
            given.append("".join(y))
    given = list(dict.fromkeys(given))
    expected = united(range(len(given)), line_links(given))
    df = spark.createDataFrame(list(enumerate(given)), "doc_id long, text string")
    got = {r["doc_id"]: r["group_doc_id"] for r in lines.line_verdicts(df).collect()}
    assert len(set(expected.values())) < len(given) - 100 and got == expected


def test_pairs_that_agree_on_no_early_coordinate_are_compared(spark, monkeypatch):
    """Leftover members of a posted list meet by all their lists, not by a few coordinates."""
    monkeypatch.setattr(minhash_join, "bucket_components", _finish_all)
    random = np.random.default_rng(13)
    rows = []
    for group in range(40):
        words = [f"g{group}w{k}" for k in range(60)]
        for _ in range(2):
            rows.append((len(rows), " ".join(w if random.random() > 0.04 else f"e{random.integers(1e9)}" for w in words)))
    sets = {i: minhash_join.shingles(t, 2) for i, t in rows}
    links = [
        (a, b) for a, b in combinations(sets, 2)
        if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    ]
    expected = united(sets, links)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in minhash_join.near_copies(df, words=2).collect()}
    assert len(links) >= 10 and got == expected


def _finish_all(members, confirm, finish, run, name):
    """Components by the second step alone."""
    ids = members.groupBy("id").count().select("id", F.col("id").alias("part"))
    return components(finish(run.write(ids, "all"), "all"), run, "all-cc")


def test_columns_that_clash_by_name_pass(spark, odd):
    names = ["_doc", "_drop", "_some", "_gone", "row", "drop", "some", "id"]
    table = odd.select("*", *[F.lit(n).alias(n) for n in names])
    left = lines.without_repeats(table)
    assert left.schema == table.schema and left.count() == lines.without_repeats(odd).count()
    near = corpus_pipeline.near(spark, table, "")
    assert near.columns == table.columns
    assert near.count() == corpus_pipeline.near(spark, odd, "").count()


def test_lists_of_the_same_members_are_worked_on_once(spark, tmp_path):
    """Copies that share many keys are compared once; no pair of another list is lost."""
    same = [(k, k, list(range(30)), list(range(100, 140 + k))) for k in range(3)]
    other = [(7, 7, [29, 50], list(range(100, 142))), (8, 8, [50], list(range(500, 540)))]
    items = spark.createDataFrame(
        same + other, "id long, part long, coords array<long>, payload array<long>"
    )
    run = RunFolder(spark, str(tmp_path))
    got = {tuple(sorted(r)) for r in blocks.links_between(items, 80, run, "e").collect()}
    assert got == {(a, b) for a, b in combinations((0, 1, 2, 7), 2)}


def test_large_groups_are_compared_in_parts(spark, tmp_path, monkeypatch):
    """Parts of a group that is too large to be held give the same components."""
    random = np.random.default_rng(14)
    base = random.integers(0, 10**6, 60)
    rows = []
    for k in range(60):
        own = base.copy()
        own[random.integers(0, 60, k % 9)] = random.integers(0, 10**6, k % 9)
        rows.append((k, k, [1], sorted({int(x) for x in own})))
    items = spark.createDataFrame(rows, "id long, part long, coords array<long>, payload array<long>")
    sets = [set(r[3]) for r in rows]
    links = [
        (a, b) for a, b in combinations(range(60), 2)
        if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    ]
    for held in (10**6, 800):
        monkeypatch.setattr(blocks, "HELD", held)
        run = RunFolder(spark, str(tmp_path / str(held)))
        got = [tuple(r) for r in blocks.links_between(items, 80, run, "e").collect()]
        assert {tuple(sorted(p)) for p in got} <= set(links)
        assert united(range(60), got) == united(range(60), links)


def test_large_lists_meet_by_their_smaller_parts(spark, tmp_path, monkeypatch):
    """A list of many blocks: no link between parts is lost, the main part is not compared."""
    monkeypatch.setattr(blocks, "BLOCK", 8)
    random = np.random.default_rng(15)
    base = random.integers(0, 10**6, 60)
    rows = []
    for k in range(120):
        own = base.copy()
        own[random.integers(0, 60, k % 9)] = random.integers(0, 10**6, k % 9)
        part = 0 if k < 90 else k
        rows.append((k, part, [1, 2 + k % 3], sorted({int(x) for x in own})))
    items = spark.createDataFrame(rows, "id long, part long, coords array<long>, payload array<long>")
    sets = [set(r[3]) for r in rows]
    linked = {
        tuple(sorted((rows[a][1], rows[b][1])))
        for a, b in combinations(range(120), 2)
        if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    }
    got = blocks.links_between(items, 80, RunFolder(spark, str(tmp_path)), "e").collect()
    parts = {tuple(sorted((rows[a][1], rows[b][1]))) for a, b in got}
    names = sorted({r[1] for r in rows})
    assert parts <= linked
    assert united(names, parts) == united(names, {p for p in linked if p[0] != p[1]})
    lists = spark.createDataFrame([(1, 120, (90, 0))], "v long, n long, main struct<own long, part long>")
    narrow = items.select("id", "part", F.lit(1).cast("long").alias("v"))
    # 30 members meet 4 blocks of their own and 12 of the main part, whose 90 meet these 4.
    assert blocks.halves(narrow, lists).count() == 30 * 16 + 90 * 4


def test_different_vectors_under_one_id_are_linked_each_on_its_own(spark):
    rows = [(1, [1.0, 0.0], 0), (1, [0.0, 1.0], 0), (2, [0.0, 2.0], 0), (3, [0.01, 1.0], 0), (4, [-1.0, 0.0], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in vectors.near_vectors(df).collect())
    assert got == [(1, 0, 1), (1, 2, 1), (2, 2, 1), (3, 2, 1), (4, 0, 4)]


def test_rows_that_share_an_id_are_packed_in_many_groups(spark, monkeypatch):
    from public_tokenizers import path

    monkeypatch.setattr(packing, "GROUP", 10)
    rows = [(None if k % 2 else 7, f"text number {k}") for k in range(200)]
    got = packing.packed(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    by = {}
    for r in got:
        by.setdefault(r.sequence_id >> 32, []).append(r)
    assert len(by) > 15 and max(map(len, by.values())) < 60
    ends = {}
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends.get(r.sequence_id, 0)
        ends[r.sequence_id] = r.offset + r.length
    assert all(e & (e - 1) == 0 for e in ends.values())
    ids = packing.encoder(*map(path, ("byte_bpe_50k.json", "byte_bpe_50k.tiktoken")))
    assert sum(r.length for r in got) == sum(len(ids(t)) + 1 for _, t in rows)
