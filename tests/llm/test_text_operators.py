"""Personal data, tokens, URL rules, shards, leaks: against plain versions and the library."""

from __future__ import annotations

import hashlib
import time
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from plain import base_spans
from pyspark.sql import functions as F

from marquee.llm import decontamination, pieces, sharding, token_counts, url_filter
from marquee.llm.personal_data import KINDS, personal_data, redact, reliable_contexts
from marquee.session import enable_checkpoints

TEXTS = [
    "", None, " ", "  ", "a", "  a  b \n\n c  ", " ▁x▁ ▁", "日本語 😀 <s></s>", "\x00 a", "a\x00", "a" * 700, "é " * 100,
    "aaaaaaa bbbb\t\t\tthethethe", "\U0001f468\u200d\U0001f469\u0301 x", "word " * 3000,
]


@pytest.fixture(scope="module")
def model():
    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as file:
        return file.read()


@pytest.fixture(scope="module")
def library(model):
    return sentencepiece.SentencePieceProcessor(model_proto=model)


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    odd = spark.createDataFrame([(-1 - i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string")
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").union(odd)


def test_token_counts(docs, model, library):
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    found = token_counts.count_tokens(docs, model, limit=100).collect()
    assert len(found) == len(texts)
    for r in found:
        n = len(library.encode(texts[r.doc_id]))
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(texts[r.doc_id].encode()), n, n > 100)


def test_pieces_equal_the_library_and_come_back(docs, model, library):
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    encoded = pieces.encode_texts(docs, model)
    for r in encoded.collect():
        assert r.ids == library.encode(texts[r.doc_id]) and r.round_trip and r.n_tokens == len(r.ids)
    back = {r.doc_id: r.text for r in pieces.decode_ids(encoded, model).collect()}
    assert back == {i: t.replace("▁", " ") for i, t in texts.items()}


def test_empty_tables_null_ids_and_other_columns(spark, model):
    rows = [(None, "a b", 1, 2), (4, None, 1, 2), (4, None, 1, 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int, spans int")
    for operator in (token_counts.count_tokens, pieces.encode_texts):
        assert sorted(r.n_tokens for r in operator(docs, model).collect()) == [0, 0, 2]
        assert operator(docs.limit(0), model).count() == 0
    assert sharding.assign_shards(docs).count() == 3 and sharding.assign_shards(docs.limit(0)).count() == 0
    assert personal_data(docs).count() == 3 and personal_data(docs.limit(0)).count() == 0
    assert redact(docs).columns == docs.columns


def _all_paths(word, score):
    if not word:
        return [(0.0, [])]
    found = []
    for n in range(1, len(word) + 1):
        own = score.get(word[:n], pieces.UNKNOWN_SCORE if n == 1 else None)
        if own is not None:
            found += [(own + s, [word[:n], *rest]) for s, rest in _all_paths(word[n:], score)]
    return found


def test_viterbi_against_all_paths(model, library):
    """Vectorised maxima with backpointers find the best of all segmentations."""
    vocabulary = pieces.Vocabulary(model)
    score = {library.id_to_piece(i): library.get_score(i) for i in range(3, 32000) if not library.is_byte(i)}
    words = ["▁theen", "▁ingers", "tionan", "▁qzx", "aeiou", "é日x"]
    for word, ids in zip(words, pieces.encode_words(vocabulary, words, merges=False)):
        best = max(s for s, _ in _all_paths(word, score))
        parts = [library.id_to_piece(int(i)) for i in ids]
        got = sum(score.get(p, pieces.UNKNOWN_SCORE) for p in parts if not p.startswith("<0x"))
        got += pieces.UNKNOWN_SCORE * sum(c not in score for c in word)
        assert abs(got - best) < 1e-6


def test_merges_against_a_loop(model, library):
    g = np.random.default_rng(1)
    words = ["▁" + "".join(g.choice(list("aeintho"), int(g.integers(1, 12)))) for _ in range(300)]
    got = pieces.encode_words(pieces.Vocabulary(model), words, merges=True)
    assert [x.tolist() for x in got] == [library.encode(w[1:]) for w in words]


PERSONAL = [
    "a@b.c@d.e", "a@b.c_x@d.e.f", "1.2.3.4.5.6.7.8", "300.1.2.3", "4532015112830366 4532015112830366",
    "x\u0001a@b.cc\u0002 1.1.1.1", "+1 (743) 555-3824 +49 30 1234567", "é😀 a.b@c.de é", "1-2-3-4", "", None, "@@",
    "+12345678901234567890", "0000001.02.3.255x", "9" * 3000 + " a@b", "a" * 3000 + "@" + "b." * 3000 + "c", "a@b.c " * 300,
]


def test_long_words_equal_the_library(model, library):
    rng = np.random.default_rng(11)
    vocabulary = pieces.Vocabulary(model)
    signs = ["abcdefghijklmnop", "ab", "aé漢字かな🏳x", "0123456789ABCDEFabcdef+/=", "\x00a", " e"]
    words = ["▁" + "".join(rng.choice(list(own), n)).replace(" ", "▁") for own in signs for n in (257, 300, 5000)] + ["▁" * 3000, "▁" + "a" * 3000, "▁" + "the" * 1000]
    for word, ids in zip(words, pieces.encode_words(vocabulary, words, merges=True)):
        assert ids.tolist() == library.encode(word[1:].replace("▁", " ")), word[:40]


@pytest.mark.parametrize("merges", [True, False])
def test_long_words_equal_batches(model, merges, monkeypatch):
    rng = np.random.default_rng(12)
    vocabulary = pieces.Vocabulary(model)
    words = ["▁" + "".join(rng.choice(list("etaoinsh漢🏳1"), n)) for n in rng.integers(1, 120, 300)]
    wanted = [ids.tolist() for ids in pieces.encode_words(vocabulary, words, merges)]
    monkeypatch.setattr(pieces, "LONG_WORD", 0)
    assert [ids.tolist() for ids in pieces.encode_words(vocabulary, words, merges)] == wanted


def test_one_word_of_100_000_signs(spark, model, library):
    text = "".join(np.random.default_rng(13).choice(list("abcdefghijklmnopqrstuvwxyz0123456789+/"), 100_000))
    frame = spark.createDataFrame([(1, text), (2, text + " " + text)], "doc_id long, text string")
    wanted = library.encode(text)
    found = {r.doc_id: r for r in pieces.encode_texts(frame, model).collect()}
    assert found[1].ids == wanted and found[2].ids == wanted * 2 and found[2].round_trip
    counted = {r.doc_id: r.n_tokens for r in token_counts.count_tokens(frame, model).collect()}
    assert counted == {1: len(wanted), 2: 2 * len(wanted)}
    vocabulary = pieces.Vocabulary(model)
    start = time.process_time()
    for merges in (True, False):
        assert len(pieces.encode_words(vocabulary, ["▁" + text], merges)[0])
    assert time.process_time() - start < 10  # the square of the length takes minutes


def test_long_pre_tokens_stay_out_of_the_summary(spark):
    frame = spark.createDataFrame([(("x" * 1000 + " word ") * 5,)], "text string")
    assert [r.token for r in token_counts.frequent_pre_tokens(frame, "text").collect()] == ["word"]



def test_base_personal_data(spark, sf_dir):
    odd = spark.createDataFrame([(-1 - i, t) for i, t in enumerate(PERSONAL)], "doc_id long, text string")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").union(odd)
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in personal_data(docs).collect():
        spans = base_spans(texts[r.doc_id])
        joined = ",".join(f"{kind}:{start}:{end}" for start, _, kind, end in spans)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in KINDS] == [sum(s[2] == k for s in spans) for k in KINDS]
        assert set(joined.split(",")) <= set(r.spans.split(","))


def test_contexts_discover_identifiers(spark):
    rows = [(i, f"Some words. My contact code: user{i}@mail.com and so on") for i in range(8)]
    rows += [(20, "Hello. My contact code: ZX-44871 bye"), (21, "an odd thing QQ-12345 here"), (22, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r for r in personal_data(docs).collect()}
    assert found[20].spans == "id:24:32" and found[20].n_id == 1 and found[21].spans == ""
    clean = {r.doc_id: r.text for r in redact(docs).collect()}
    assert clean[20] == "Hello. My contact code: <id> bye" and clean[21] == rows[9][1] and clean[22] is None
    assert clean[3] == "Some words. My contact code: <email> and so on"


def test_identifiers_and_contexts_of_any_length(spark):
    """A key of 3001 signs and context words of 200 signs."""
    far = "k" * 200
    rows = [(i, f"Text. My {far} code: user{i}@mail.com and so on") for i in range(8)]
    rows += [(20, f"My {far} code: {'Z9-' * 1000}a... bye"), (21, f"Other {far} code: QQ-12345 here")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r for r in personal_data(docs).collect()}
    at = rows[8][1].index("Z9")
    assert found[20].spans == f"id:{at}:{at + 3001}" and found[21].n_id == 1


def test_scores_run_until_they_settle(spark):
    """A chain of contexts, each of which knows the identifiers of the one before only."""
    rows = [("c0", f"i0_{j}", True) for j in range(40)]
    for hop in range(6):
        rows += [(f"c{hop}", f"i{hop + 1}_{j}", False) for j in range(2)]
        rows += [(f"c{hop + 1}", f"i{hop + 1}_{j}", False) for j in range(2)] + [(f"c{hop + 1}", f"k{hop}_{j}", True) for j in range(4)]
        rows += [(f"c{hop + 1}", f"i{hop + 1}_{j}", False) for j in range(2)]
    pairs = spark.createDataFrame(rows, "context string, identifier string, known boolean")
    enable_checkpoints(spark)
    found = {r.context: r.confidence for r in reliable_contexts(pairs).collect()}
    score, names = {i: float(any(k for _, x, k in rows if x == i)) for _, i, _ in rows}, {c for c, _, _ in rows}
    known = {i for _, i, k in rows if k}
    for _ in range(200):
        own = {c: {i for x, i, _ in rows if x == c} for c in names}
        confidence = {c: sum(score[i] for i in own[c]) / (len(own[c]) + 1) for c in names}
        for i in score.keys() - known:
            score[i] = 1 - float(np.prod([1 - confidence[c] for c in names if i in own[c] and confidence[c] >= 0.5]))
    assert found.keys() == {c for c in names if confidence[c] >= 0.75}
    assert all(abs(found[c] - confidence[c]) < 1e-4 for c in found)


RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/")]


def plain_verdict(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host, rest = rest[:end].translate({c: c + 32 for c in range(65, 91)}), rest[end:]
        path = rest[: min([rest.find(c) for c in "?#" if c in rest], default=len(rest))]
    fitting = []
    for kind, rule in RULES:
        own, start = rule[: rule.index("/")], rule[rule.index("/") :]
        if (host == own or host.endswith("." + own)) and path.startswith(start):
            fitting.append((len(rule), rule, kind))
    return (host, path, *(max(fitting)[1:] if fitting else (None, None)))


def test_url_rules(spark, sf_dir):
    odd = [None, "", "x", "HTTP://A.Example.COM/en/x", "http://www.example.com/en/?a", "//x.net/es/", "a://b.net/es/?q://z"]
    odd += ["http://net/es/", "http://xcom/", "http://com", "a://b://c.com/", "http://é.com/é/%20#x", "h://" + "a." * 3000 + "com/"]
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    pages = pages.union(spark.createDataFrame([(-1 - i, u) for i, u in enumerate(odd)], "page_id long, url string"))
    urls = {r.page_id: r.url for r in pages.collect()}
    for r in url_filter.judge_urls(pages, RULES).collect():
        host, path, rule, verdict = plain_verdict(urls[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == verdict if verdict else r.verdict in ("allow", "block")


def test_urls_without_labels(spark):
    pages = spark.createDataFrame([(1, "http://a.com/x"), (None, None)], "page_id long, url string")
    assert {r.verdict for r in url_filter.judge_urls(pages, []).collect()} == {"allow"}
    assert {r.verdict for r in url_filter.judge_urls(pages, [("block", "a.com/")]).collect()} == {"block"}
    assert url_filter.judge_urls(pages.limit(0), RULES).count() == 0


def test_trees_learn_from_lexical_features(spark):
    """Long digit-laden hosts are blocked by rule; unruled ones of that kind are too."""
    rows = [(i, f"http://win{i * 7919}-{i}x{i}.shop/p?a={i}&b={i}&c=9") for i in range(300)]
    rows += [(1000 + i, f"http://news.site/story/{'abcdefgh'[i % 8]}") for i in range(300)]
    rows += [(5000, "http://win99182-771x5.other/p?a=1&b=2&c=3"), (5001, "http://news.other/story/c")]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    found = {r.page_id: r.verdict for r in url_filter.judge_urls(pages, [("block", "shop/"), ("allow", "site/")]).collect()}
    assert (found[5000], found[5001]) == ("block", "allow")


def test_every_labelled_suffix_has_statistics(spark):
    """A suffix keeps its statistics however many commoner ones there are, and by either join."""
    rows = [(f"x{i % 5000}.com", 0.0) for i in range(10_000)] + [("rare.net", 1.0)]
    labelled = spark.createDataFrame(rows, "suffix string, blocked double")
    statistics = url_filter.suffix_statistics(labelled).checkpoint()
    assert statistics.count() == 5001
    rates = {r.suffix: r.suffix_rate for r in statistics.collect()}
    assert rates["rare.net"] > rates["x1.com"]
    urls = labelled.select("suffix").union(spark.createDataFrame([("none.org",), ("",)], "suffix string")).withColumn("url", F.col("suffix"))
    one, two = (sorted(url_filter.with_statistics(urls, statistics, b).select("suffix", "suffix_rate", "suffix_share").collect(), key=str) for b in (1 << 30, 0))
    assert len(one) == len(rows) + 2 and one == two and {r.suffix: r.suffix_rate for r in one} == rates | {"none.org": None, "": None}


def test_shards_fit_and_split_only_when_full(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    limit = 40_000
    shards = sharding.assign_shards(docs, limit=limit)
    sizes = {r.shard: r for r in shards.groupBy("shard").agg(F.sum("n_bytes").alias("bytes"), F.count(F.lit(1)).alias("rows")).collect()}
    assert sum(r.rows for r in sizes.values()) == docs.count()
    assert all(r.bytes <= limit or r.rows == 1 for r in sizes.values())
    names = list(sizes)
    assert not any(a != b and b.startswith(a) for a in names for b in names)
    for name in names:  # the parent of every shard was too large
        parent = [r for n, r in sizes.items() if n.startswith(name[:-1])]
        assert sum(r.bytes for r in parent) > limit and sum(r.rows for r in parent) > 1


def test_copies_are_split_too(spark):
    rows = [(1, "a" * 100)] * 50 + [(2, None), (None, "b" * 500), (None, "c" * 20)]
    found = sharding.assign_shards(spark.createDataFrame(rows, "doc_id long, text string"), limit=300)
    sizes = found.groupBy("shard").agg(F.sum("n_bytes").alias("bytes"), F.count(F.lit(1)).alias("rows")).collect()
    assert sum(r.rows for r in sizes) == 53 and all(r.bytes <= 300 or r.rows == 1 for r in sizes)


def test_written_shards(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    sharding.write_shards(docs, str(tmp_path / "shards"), limit=100_000)
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert back.select(docs.columns).exceptAll(docs).isEmpty() and back.count() == docs.count()


def test_leaks_are_found_whole(spark, sf_dir):
    docs, items = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    plain = {r.doc_id: " ".join((r.text or "").split()).lower() for r in docs.collect()}
    want = {(d, i.item_id) for i in items.collect() for d, t in plain.items() if " ".join(i.text.split()).lower() in t}
    found = decontamination.leaked_passages(docs, items).collect()
    assert {(r.doc_id, r.item_id) for r in found} == want and want
    left = {r.doc_id for r in decontamination.decontaminate(docs, items).collect()}
    assert left == set(plain) - {d for d, _ in want}


def test_paraphrases_need_the_answer(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    item = [f"term{i}" for i in range(30)]
    loose = " ".join(w for i, w in enumerate(item) if i % 3)  # two thirds of the words
    rows = [(-1, loose), (-2, f"{loose} the answer is forty two"), (-3, "forty two"), (-4, " ".join(item)), (-5, None)]
    docs = docs.union(spark.createDataFrame(rows, "doc_id long, text string"))
    items = spark.createDataFrame([(1, " ".join(item), "forty two"), (2, None, None), (3, "", "x")], "item_id long, text string, answer string")
    found = decontamination.leaked_passages(docs, items, answer_col="answer").collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(-2, 1), (-4, 1)}
    assert decontamination.leaked_passages(docs, items.limit(0)).count() == 0
    assert decontamination.leaked_passages(docs.limit(0), items).count() == 0


def test_rows_are_decontaminated_one_by_one(spark, sf_dir):
    """Null ids and an id with a leaking and a clean text: only the leaking rows go."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    leak = items.first().text
    rows = [(None, leak), (None, "clean one"), (None, None), (7, leak), (7, "clean two"), (7, "clean two"), (8, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    left = decontamination.decontaminate(docs, items).collect()
    assert sorted(map(tuple, left), key=str) == sorted((r for r in rows if r[1] != leak), key=str)
    assert decontamination.decontaminate(docs, items.limit(0)).count() == len(rows)


def test_paraphrases_of_common_words_are_found(spark):
    """Items of which the rarest 45 percent of words are replaced, the closing words kept: every plant is a leak."""
    docs, items = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "benchmark"))
    texts = [(r.text or "").split() for r in docs.select("text").collect()]
    often = Counter(w.lower() for t in texts for w in set(t))
    g, plants, want = np.random.default_rng(8), [], set()
    for item in items.collect():
        words = item.text.split()
        body = sorted(range(len(words) - decontamination.ANSWER_WORDS), key=lambda i: often[words[i].lower()])
        for i in body[: int(0.45 * len(words))]:
            words[i] = f"zz{item.item_id}y{i}"
        for _ in range(5):
            own = texts[int(g.integers(len(texts)))]
            at = int(g.integers(len(own) + 1))
            plants.append((100_000 + len(plants), " ".join([*own[:at], *words, *own[at:]])))
            want.add((plants[-1][0], item.item_id))
    both = docs.select("doc_id", "text").union(spark.createDataFrame(plants, "doc_id long, text string"))
    found = {(r.doc_id, r.item_id) for r in decontamination.leaked_passages(both, items).collect()}
    assert want <= found, f"{len(want - found)} of {len(want)} lost"


def test_common_subsequence():
    g = np.random.default_rng(4)
    regions, window = g.integers(1, 6, (40, 25)).astype(np.uint64), g.integers(1, 6, 12).astype(np.uint64)
    for row, got in zip(regions, decontamination.common_subsequences(regions, window)):
        table = np.zeros((len(row) + 1, len(window) + 1), int)
        for i, a in enumerate(row):
            for j, b in enumerate(window):
                table[i + 1, j + 1] = table[i, j] + 1 if a == b else max(table[i, j + 1], table[i + 1, j])
        assert got == table[-1, -1]


def test_very_many_identifiers_in_one_text(spark):
    """Time in proportion: 100,000 identifier words, and 20,000 base matches beside them."""
    many = " ".join(f"key k{i}x" for i in range(100_000))
    mixed = " ".join(f"mail a{i}@b.org or ref r{i}z" for i in range(20_000))
    docs = spark.createDataFrame([(1, many), (2, mixed)], "own_key long, text string")
    found = {r.own_key: r for r in personal_data(docs, id_col="own_key").collect()}
    assert found[1].n_email == 0 and found[2].n_email == 20_000
    first = [f"{kind}:{start}:{end}" for start, _, kind, end in base_spans(mixed)[:3]]
    assert found[2].spans.split(",")[:3] == first
    clean = {r.own_key: r.text for r in redact(docs).collect()}
    assert clean[2].count("<email>") == 20_000 and not base_spans(clean[2])


def test_redacted_text_is_cut_by_hand(spark):
    rows = [(1, "x a@b.co y +1 202 555 0100 z 1.2.3.4"), (2, None), (3, ""), (4, "none"), (5, "é a@b.co漢 " * 700)]
    docs = spark.createDataFrame([(*r, 0, "k") for r in rows], "doc_id long, text string, own_spans int, own_more string")
    found = {r.doc_id: r.text for r in redact(docs).collect()}
    for i, text in rows:
        want, at = "", 0
        for start, _, kind, end in base_spans(text):
            if start >= at:
                want += text[at:start] + f"<{kind}>"
            at = max(at, end)
        assert found[i] == (text and want + text[at:])
