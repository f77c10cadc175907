"""The training-data operators against brute force, on small tables with the awkward cases."""

import hashlib
import random
import re
import tracemalloc
import zlib
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from shelfpanel.llm import (
    bpe, common, decontaminate, exact_dedup, language_id, licenses, near_dedup, pii, quality, queries, toxicity, url_filter,
)

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
SF = "/root/testdata/sf0.001"


def documents(spark, texts, schema=SCHEMA):
    rows = [(i, t, "en", "s", None) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, schema)


def folded(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def random_texts(seed, n, words=("the", "Cat", "é", "x1", "Éa", "sat,", "on"), most=40):
    draw = random.Random(seed)
    return [" ".join(draw.choice(words) for _ in range(draw.randint(0, most))) for _ in range(n)]


@pytest.fixture(autouse=True, scope="module")
def folder(spark, tmp_path_factory):
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.conf.set("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))


# Helpers


def test_word_hashes_agree_across_chunks(monkeypatch):
    texts = [b"", b"  one Two\tone", ("wort é " * 50).encode(), b"x" * 3000 + b" y", b"two"]
    whole, counts = common.word_hashes(texts, common.NOT_BLANK)
    assert counts.tolist() == [len(t.split()) for t in texts]
    assert len(set(whole.tolist())) == len({w.lower() for t in texts for w in t.split()})
    monkeypatch.setattr(common, "CHUNK", 64)
    again, parts = common.word_hashes(texts, common.NOT_BLANK)
    assert (again == whole).all() and (parts == counts).all()


def test_taken_slots(spark):
    keys = spark.range(500).select((F.col("id") * 7919).alias("k"))
    bits = common.taken_slots(keys)
    slots = np.array([r[0] for r in keys.select(common.slot(F.col("k"))).collect()])
    assert common.slot_is_taken(bits, slots).all()
    assert not common.slot_is_taken(bits, np.setdiff1d(np.arange(20000), slots)).any()


def test_held_out(spark):
    found = spark.range(50).select(common.held_out(F.col("id"))).collect()
    assert [r[0] for r in found] == [zlib.crc32(str(i).encode()) % 5 == 0 for i in range(50)]


def test_decontamination_reads_documents_once(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK", 4)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    windows = decontaminate.benchmark_windows(spark.createDataFrame([(1, "a b c d e f g h i")], "item_id bigint, text string"), 2)
    plan = decontaminate.hit_words(docs, windows)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parquet") == 1


# 4 exact copies


@pytest.mark.parametrize("keep", ["smallest", "largest"])
def test_exact_groups(spark, keep, monkeypatch):
    monkeypatch.setattr(exact_dedup, "LEAST_RUN", 4)  # hot texts on a small table
    texts = random_texts(1, 60, most=2) + [None, "", "AÉ", "aÉ", "aé"] + ["Hot Text"] * 30 + ["long " * 30000] * 2
    got = exact_dedup.exact_groups(documents(spark, texts), keep=keep).collect()
    groups = {}
    for i, t in enumerate(texts):
        groups.setdefault(folded(t), []).append(i)
    assert len(got) == len(texts)
    for r in got:
        own = groups[folded(texts[r.doc_id])]
        best = min(own) if keep == "smallest" else max(own)
        digest = hashlib.sha256(folded(texts[r.doc_id]).encode()).hexdigest()
        assert (r.keep_id, r.group_size, r.kept, r.text_sha256) == (best, len(own), r.doc_id == best, digest)


def test_exact_repeats_nulls_and_clashing_names(spark):
    rows = [(1, "a", "x"), (1, "a", "x"), (None, "a", "y"), (None, "b", "z")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, keep_id string")
    df = df.withColumn("norm", F.lit(1)).withColumn("digest", F.lit(2))
    kept = exact_dedup.drop_copies(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id or 0, r.text, r.keep_id) for r in kept.collect()) == [(0, "b", "z"), (1, "a", "x")]
    assert exact_dedup.drop_copies(df.limit(0)).count() == 0


# 2 decontamination


def brute_contamination(docs, items, size=10):
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = {}
    for item, text in items:
        words = pattern.findall(folded(text))
        k = min(size, len(words))
        for i in range(len(words) - k + 1) if words else []:
            windows.setdefault(tuple(words[i : i + k]), set()).add(str(item))
    out = {}
    for doc, text in docs:
        words, hit, found = pattern.findall(folded(text)), set(), set()
        for k in {len(w) for w in windows}:
            for i in range(len(words) - k + 1):
                if (own := windows.get(tuple(words[i : i + k]))) is not None:
                    hit |= set(range(i, i + k))
                    found |= own
        out[doc] = (len(words), len(hit), sorted(found))
    return out


def test_contamination(spark, monkeypatch):
    letters = [chr(97 + i) for i in range(4)]
    items = [(i, t) for i, t in enumerate(random_texts(2, 12, letters, 30) + [None, "", "q Rr", "ééÉ z9"])]
    texts = random_texts(3, 60, letters, 60) + [None, "", "...", "Q, rr! " * 3, "x ééÉ Z9 ééé z9", "a b c d " * 2000]
    texts += [t + " " + items[0][1] + " tail" for t in texts[:5]]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    docs = documents(spark, texts)
    wanted = brute_contamination(enumerate(texts), items, 6)
    for block in (decontaminate.BLOCK, 40):
        monkeypatch.setattr(decontaminate, "BLOCK", block)
        got = {r.doc_id: (r.n_words, r.n_hit, list(r["items"])) for r in decontaminate.contamination(docs, benchmark, 6).collect()}
        assert got == wanted
    kept = decontaminate.remove_documents(docs.withColumn("n_hit", F.lit("x")), benchmark, 6)
    assert {r.doc_id for r in kept.collect()} == {d for d, w in wanted.items() if not w[1]}
    again = decontaminate.contamination(decontaminate.remove_spans(docs, benchmark, 6), benchmark, 6).collect()
    assert {r.doc_id: r.n_words for r in again} == {d: w[0] - w[1] for d, w in wanted.items()}


def test_a_window_shared_by_many_items(spark):
    items = [(i, "same words again " + f"item{i}") for i in range(300)] + [(None, "same words again")]
    docs = documents(spark, ["x same words, again y"] * 40 + ["same words again item7", "other"])
    got = {r.doc_id: (r.n_hit, set(r["items"])) for r in decontaminate.contamination(docs, spark.createDataFrame(items, "item_id bigint, text string"), 3).collect()}
    everyone = {str(i) for i in range(300)}
    assert got == {i: (3, everyone) for i in range(40)} | {40: (4, everyone), 41: (0, set())}


def test_contamination_of_nothing(spark):
    docs = documents(spark, ["a b", None])
    benchmark = spark.createDataFrame([], "item_id bigint, text string")
    assert decontaminate.remove_documents(docs, benchmark).count() == 2
    assert decontaminate.contamination(docs.limit(0), benchmark).count() == 0


# 5 near copies


def brute_components(texts, percent, width=5):
    sets = []
    for t in texts:
        words = re.findall(r"[^\x20\x09-\x0D]+", folded(t))
        size = min(width, len(words))
        sets.append({tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if words else set())
    root = list(range(len(texts)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                a, b = top(i), top(j)
                root[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), top(i)) for i in range(len(texts))}


def edited(draw, words, changes):
    words = list(words)
    for _ in range(changes):
        words[draw.randrange(len(words))] = f"new{draw.randrange(10**6)}"
    return " ".join(words)


@pytest.mark.parametrize("hot,percent", [(near_dedup.HOT, 85), (3, 85), (3, 80)])
def test_near_groups(spark, hot, percent, monkeypatch):
    monkeypatch.setattr(near_dedup, "HOT", hot)  # short lists become long ones: the exact way for popular texts
    draw = random.Random(4)
    fresh = lambda n: [f"w{draw.randrange(10**6)}" for _ in range(n)]
    base, passage = fresh(120), fresh(60)
    texts = [edited(draw, base, draw.randrange(6)) for _ in range(50)] + [" ".join(base)] * 3
    texts += [" ".join(passage + fresh(draw.choice([3, 8, 12, 60]))) for _ in range(40)]
    texts += [" ".join(base[: 120 - 2 * k]) for k in range(30)]
    chain = fresh(100)
    for _ in range(20):
        chain = chain[1:] + fresh(1)
        texts.append(" ".join(chain))
    texts += [None, "", "  ", "One two", "one  TWO", "one", "a b c d e", "a b c d f", "a b c d e a b c d e", "x " * 3000]
    texts += random_texts(5, 30, most=9)
    got = near_dedup.near_groups(documents(spark, texts), percent=percent).collect()
    wanted = brute_components(texts, percent)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == wanted
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_near_copies_keep_columns_nulls_and_repeats(spark):
    rows = [(5, "a b c d e f", 1), (5, "a b c d e f", 1), (None, "a b c d e f", 2), (7, "A B C D E F", 3), (8, None, 4)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, root int")
    kept = near_dedup.drop_near_copies(df)
    assert kept.columns == df.columns
    assert sorted(r.root for r in kept.collect()) == [1, 1, 2, 4]
    assert near_dedup.near_groups(df.limit(0)).count() == 0


def test_families_of_a_popular_passage_with_tails_of_their_own(spark, monkeypatch):
    """All that a member shares with another is popular: their index values with short lists have lists of one."""
    monkeypatch.setattr(near_dedup, "HOT", 3)
    assert near_dedup.hot_bound(80) == 5 and near_dedup.hot_bound(85) >= 6
    draw = random.Random(8)
    fresh = lambda n: [f"w{draw.randrange(10**6)}" for _ in range(n)]
    texts = []
    for _ in range(6):
        passage = fresh(200)
        texts += [" ".join(passage + fresh(draw.choice([8, 20, 24, 30, 60]))) for _ in range(8)]
    got = near_dedup.near_groups(documents(spark, texts), percent=80).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_components(texts, 80)


def test_rows_that_repeat_an_id_with_other_texts(spark):
    a, b = "a b c d e f g", "v w x y z u t"
    df = spark.createDataFrame([(1, a), (2, a), (2, b), (3, b), (2, "p q r s t u v w")], "doc_id bigint, text string")
    assert sorted(tuple(r) for r in near_dedup.drop_near_copies(df).collect()) == [(1, a), (2, "p q r s t u v w"), (2, b)]


def test_names_of_extra_columns_do_not_clash(spark):
    names = ["id", "code", "hits", "row", "base", "terms", "__id", "__code", "__hits", "__base", "__terms", "text_code", "n_hit", "__gone", "kept", "root", "n"]
    df = spark.createDataFrame([(1, "one two three four mail a@b.example.com", *names)], ["doc_id", "text", *names])
    bench = spark.createDataFrame([(1, "two three")], "item_id bigint, text string")
    cut = decontaminate.remove_spans(df, bench).collect()
    assert cut[0][1] == "one   four mail a@b.example.com" and list(cut[0][2:]) == names
    assert decontaminate.remove_documents(df, bench).collect() == [] and near_dedup.drop_near_copies(df).collect() == df.collect()
    clean = pii.sanitised(df).collect()
    assert clean[0][1] == "one two three four mail [EMAIL]" and list(clean[0][2:]) == names


def test_labels_without_usable_texts_take_no_place_of_the_sample(spark, monkeypatch):
    for module in (toxicity, quality):
        monkeypatch.setattr(module, "SAMPLE_BYTES", 100)
    ids = [i for i in range(200) if not common.is_held_out(i)]
    docs = spark.createDataFrame([(i, f"text {i % 2} " + "x" * (1000 if i < 100 else 1)) for i in range(150)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(200)], "doc_id bigint, toxic int, grade int")
    usable = [i for i in ids if 100 <= i < 150]
    _, _, counts, y, share = toxicity.training_sample(docs, labels, "toxic", "doc_id", "text", limit=30)
    assert len(y) == len(counts) == min(20, sum(i % 2 == 0 for i in usable)) + min(10, sum(i % 2 for i in usable))
    assert share == pytest.approx(sum(i % 2 for i in usable) / len(usable))
    seen = []
    monkeypatch.setattr(quality.OrdinalModel, "fit", lambda self, texts, y: seen.append(len(texts)) or self)
    quality.train(docs, labels, limit=20)
    assert seen == [20]


def test_components_of_a_long_path(spark):
    links = spark.range(1, 200).select((F.col("id") - 1).alias("a"), F.col("id").alias("b"))
    assert {r.root for r in near_dedup.components(links).collect()} == {0}


# 7 BPE


def test_bpe_against_the_library(spark):
    tokenizers = pytest.importorskip("tokenizers")
    path = queries.vocab_path()
    reference = tokenizers.Tokenizer.from_file(path)
    draw = random.Random(6)
    letters = list("abcE'sStrvemlLdD 12\t\n\r\x1c\x85\xa0éÉΣσςİßẞ²½ªⅠ中😀\u200d.,!?-_#@<|>") + ["e\u0301", "<|endoftext|>"]
    texts = ["".join(draw.choice(letters) for _ in range(draw.randint(0, 60))) for _ in range(1500)]
    texts += [None, "", "a" * 5000, "ab" * 400 + " x", "ΑΣ", "word " * 20000]
    got = {r.doc_id: r for r in bpe.encode_decode(documents(spark, texts), path).collect()}
    for i, text in enumerate(texts):
        ids = reference.encode(text or "", add_special_tokens=False).ids
        assert np.frombuffer(got[i]["ids"], "<u4").tolist() == ids and got[i].n_tokens == len(ids)
        assert got[i].decoded == reference.decode(ids, skip_special_tokens=False)


# 3 URLs


def test_urls(spark):
    urls = [
        None, "", "no scheme", "http://", "HTTP://WWW.Example.ORG/es/1?x", "https://example.org/en/12", "http://a.b.com/de/", "x://y.com/de",
        "http://example.org", "http://bexample.org/es/", "http://fr.com/fr/?q=://z", "http://É.com/De/", "http://a.net#f/://b",
    ]
    wanted = [
        ("", "", None), ("", "", None), ("", "", None), ("", "", None), ("www.example.org", "/es/1", "example.org/es/"),
        ("example.org", "/en/12", "example.org/en/1"), ("a.b.com", "/de/", "com/de/"), ("y.com", "/de", None), ("example.org", "", None),
        ("bexample.org", "/es/", "org/"), ("fr.com", "/fr/", "com/fr/"), ("É.com", "/De/", None), ("a.net", "", None),
    ]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string").withColumn("host", F.lit(1))
    got = {r.page_id: r for r in url_filter.judge_urls(pages).collect()}
    rules = {rule: verdict for verdict, rule in url_filter.RULES}
    for i, (host, path, rule) in enumerate(wanted):
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule)
        assert got[i].verdict == (rules[rule] if rule else "block" if got[i].score >= 0.5 else "allow")
    assert url_filter.judge_urls(pages.limit(0)).count() == 0


def test_url_model_on_unseen_hosts():
    model = url_filter.UrlModel(url_filter.labelled_urls())
    assert all(model.score(h, "/en/5") >= 0.5 for h in ("m.casino-spin.example.com", "pills-cheap.example.net", "ads-track.example.org"))
    assert all(model.score(h, "/en/5") < 0.5 for h in ("thernd.example.com", "www.history-club.example.org", "blog.example.net"))


def test_url_scores_of_a_batch_equal_single_ones(monkeypatch):
    monkeypatch.setattr(url_filter, "RUN", 300)
    model, draw = url_filter.UrlModel(url_filter.labelled_urls()), random.Random(12)
    parts = ["", "a", "É中", "casino-win.example.com", "x" * 2000, "/pills/buy", "/win" * 400]
    hosts = [draw.choice(parts) for _ in range(200)] + [""] * 5
    paths = [draw.choice(parts) for _ in range(200)] + [""] * 5
    assert np.allclose(model.scores(hosts, paths), [direct_url_score(model, h, p) for h, p in zip(hosts, paths)], atol=1e-12)
    assert np.allclose(model.scores(hosts, paths), [model.score(h, p) for h, p in zip(hosts, paths)], atol=1e-12)
    assert len(model.scores([], [])) == 0


def direct_url_score(model, host, path):
    """N-gram by n-gram, with whole numbers of any length."""
    counts = {}
    for seed, part in ((17, host), (29, path)):
        codes = list(("^" + part + "$").encode())
        for size in url_filter.SIZES:
            for i in range(len(codes) - size + 1):
                h = seed * 31 + size
                for code in codes[i : i + size]:
                    h = (h * 0x100000001B3 + code + 1) % 2**64
                place = (h ^ (h >> 29)) % url_filter.BUCKETS
                counts[place] = counts.get(place, 0) + 1
    length = max(1e-9, sum(c * c for c in counts.values()) ** 0.5)
    logit = sum(model.weights[b] * c for b, c in counts.items()) / length + model.bias
    return 1 / (1 + np.exp(-logit))


def test_urls_without_a_labelled_table(spark):
    pages = spark.createDataFrame([(1, "http://a.net/" + "b" * 200_000)], "page_id bigint, url string")
    assert [(r.score, r.verdict) for r in url_filter.judge_urls(pages, labelled=[]).collect()] == [(0.5, "block")]


# 1 personal data

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        total += int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10))
    return total % 10 == 0


def brute_spans(text):
    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(int(x) <= 255 for x in m.group().split("."))]
    for m in CARD.finditer(text):
        digits = re.sub("[^0-9]", "", m.group())
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    return out + [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15]


def test_base_spans():
    draw = random.Random(8)
    alphabets = ["a@.-%é", "0123456789.", "0123456789 -", "+0123456789 ().-", "a@b.c1+2 -(é"]
    for _ in range(6000):
        text = "".join(draw.choice(draw.choice(alphabets)) for _ in range(draw.randint(0, 40)))
        assert pii.base_spans(text) == brute_spans(text), text
    assert pii.base_spans("1" * 200_000 + "a" * 200_000 + "@" * 1000) == []


def test_disclosing_terms(spark):
    texts = [f"filler{i} the lot is here" for i in range(200)]
    texts += [f"report {i} from Zanzibar captain ann@mail.example.com about the lot" for i in range(4)]
    texts += [None, "", "the captain of é ann", "mail bob@x.org once"]
    docs = documents(spark, texts).withColumn("base", F.lit("x"))
    got = {r.doc_id: r for r in pii.disclosure(docs).collect()}
    assert len(got) == len(texts)
    for i in range(200, 204):
        text = texts[i]
        terms = {text[t.start : t.end] for t in got[i].terms}
        assert "Zanzibar" in terms and "captain" in terms and "the" not in terms and "lot" not in terms
        assert got[i].n_email == 1 and got[i].base == f"email:{text.index('ann')}:{text.index(' about')}"
    assert all(not got[i].terms for i in got if i not in range(200, 204))
    clean = {r.doc_id: r.text for r in pii.sanitised(docs, remove=0.99).collect()}
    assert clean[204] is None and clean[206] == texts[206] and clean[0] == texts[0]
    assert "ann@" not in clean[201] and "[EMAIL]" in clean[201] and "Zanzibar" not in clean[201] and "the lot" in clean[201]
    assert pii.disclosure(docs.limit(0)).count() == 0


def brute_disclosure(texts, threshold):
    """Marked terms of each text, in all texts, by counting each pair of a value and a term."""
    values, terms, words = [], [], []
    for text in texts:
        spans = pii.base_spans(text)
        values.append({pii.entity(k, text[s:e]) for k, s, e in spans})
        terms.append([m for m in pii.TERM.finditer(text) if all(e <= m.start() or s >= m.end() for _, s, e in spans)])
        words.append({folded(m.group()) for m in pii.TERM.finditer(text)})
    telling, n = set(), len(texts)
    for v in set().union(*values):
        own = [i for i in range(n) if v in values[i]]
        for t in set().union(*words):
            both = [i for i in own if t in {folded(m.group()) for m in terms[i]}]
            if len({texts[i] for i in both}) > 1 and len(own) < n:
                weight = np.log(n * len(both) / (len(own) * sum(t in w for w in words))) / np.log(n / len(own))
                telling |= {t} if weight >= threshold else set()
    return [{m.span() for m in found if folded(m.group()) in telling} for found in terms]


def test_disclosing_terms_of_whole_texts(spark):
    far = " ".join(f"pad{c}" for c in "abcdefghijklmnopqrstuvwxyz")
    texts = [f"filler{i} the lot is here" for i in range(200)] + [
        f"{i} Zanzibar captain {far} ann@mail.example.com the lot" for i in range(4)
    ] + ["the Zanzibar captain sails"]
    docs = documents(spark, texts)
    for everywhere in (False, True):
        got = {r.doc_id: {texts[r.doc_id][t.start : t.end] for t in r.terms} for r in pii.disclosure(docs, everywhere=everywhere).collect()}
        assert all({"Zanzibar", "captain"} <= got[i] and "lot" not in got[i] for i in range(200, 204))
        assert got[204] == ({"Zanzibar", "captain"} if everywhere else set())
    clean = {r.doc_id: r.text for r in pii.sanitised(docs, everywhere=True).collect()}
    assert clean[204] == "the [TERM] [TERM] sails" and "Zanzibar" not in clean[200] and clean[0] == texts[0]


def test_disclosing_terms_against_brute_force(spark):
    draw = random.Random(5)
    words = ["ann@x.org", "Bob@y.net", "10.0.0.1", "+49 30 1234567", "bob@y.neté", *[f"w{c}" for c in "abcdefghijklmnop"], "Éa"]
    texts = [" ".join(draw.choices(words, [1] * 5 + [2] * 17, k=draw.randint(0, 14))) for _ in range(60)] + [f"other {i}" for i in range(200)]
    got = {r.doc_id: {(t.start, t.end) for t in r.terms} for r in pii.disclosure(documents(spark, texts), 0.6, everywhere=True).collect()}
    wanted = brute_disclosure(texts, 0.6)
    assert any(wanted) and [got[i] for i in range(len(texts))] == wanted


# 6, 8, 10 trained models


def test_forward_backward_against_all_paths():
    draw = np.random.default_rng(1)
    scores, moves, ends = draw.normal(size=(5, 3)), draw.normal(size=(3, 3)), np.array([0, 2, 5])
    got = language_id.forward_backward(scores, moves, ends)
    for start, end in ((0, 2), (2, 5)):
        n = end - start
        wanted = np.zeros((n, 3))
        for code in range(3**n):
            path = [code // 3**k % 3 for k in range(n)]
            weight = np.exp(sum(scores[start + i, y] for i, y in enumerate(path)) + sum(moves[a, b] for a, b in zip(path, path[1:])))
            for i, y in enumerate(path):
                wanted[i, y] += weight
        assert np.allclose(got[start:end], wanted / wanted.sum(axis=1, keepdims=True))


def test_language_accuracy_and_odd_texts(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = language_id.train(docs)
    found = language_id.identify(docs, model).join(docs, "doc_id").where(common.held_out(F.col("doc_id")))
    assert found.agg(F.avg((F.col("lang_pred") == F.col("lang")).cast("int"))).first()[0] > 0.9
    odd = documents(spark, [None, "", "12 34 !", "\u2013 \u2026", "the and of " * 20000])
    got = [(r.lang_pred, r.score) for r in language_id.identify(odd, model).orderBy("doc_id").collect()]
    assert got[:4] == [("und", 0.0)] * 4 and got[4][0] == "en" and 0.5 < got[4][1] <= 1
    empty = language_id.train(docs.limit(0))
    assert {r.lang_pred for r in language_id.identify(odd, empty).collect()} == {"und"}


def test_training_on_a_language_without_blanks(monkeypatch):
    draw = random.Random(3)
    plain = " ".join("".join(draw.choices("abcdefgh", k=5)) for _ in range(200)).encode()
    runs = " ".join("".join(draw.choices("\u4e00\u4e01\u4e8c\u4eba\u5927", k=300)) for _ in range(30)).encode()
    model = language_id.LanguageModel(["en", "zh"]).fit([plain, runs], np.array([0, 1]), rounds=1)
    assert model.predict([plain, runs])[0] == ["en", "zh"]
    monkeypatch.setattr(common, "CHUNK", 1 << 22)
    whole = language_id.LanguageModel(["en", "zh"]).fit([plain, runs], np.array([0, 1]), rounds=1)
    assert np.allclose(model.weights, whole.weights, atol=1e-4) and np.allclose(model.moves, whole.moves)


def test_code_switched_words(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = language_id.train(docs)
    text = b"the and of which this that with " + "der die und nicht ein mit von auf".encode()
    scores, counts = model.word_scores([text])
    chances = language_id.forward_backward(scores.astype(float), model.moves, np.cumsum(counts))
    names = [model.languages[k] for k in chances.argmax(axis=1)]
    assert names.count("en") >= 5 and names.count("de") >= 5 and names[0] == "en" and names[-1] == "de"


def test_toxicity(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    model = toxicity.train(docs, labels)
    held = toxicity.score(docs, model).where(common.held_out(F.col("doc_id"))).join(labels, "doc_id")
    rows = held.select("score", "toxic", "predicted").collect()
    assert all(r.predicted == int(r.score >= 0.5) for r in rows)
    toxic, clean = [r.predicted for r in rows if r.toxic], [r.predicted for r in rows if not r.toxic]
    assert np.mean(toxic) > 0.7 and np.mean(clean) < 0.02
    odd = documents(spark, [None, "", "1 2", "idiot " * 60000])
    scores = [r.score for r in toxicity.score(odd, model).orderBy("doc_id").collect()]
    assert scores[0] == scores[1] == scores[2] and all(0 <= s <= 1 for s in scores)
    assert toxicity.drop_toxic(odd.withColumn("score", F.lit("x")), model).columns == [*odd.columns, "score"]
    none = toxicity.train(docs, labels.limit(0))
    assert {r.score for r in toxicity.score(odd, none).collect()} == {0.0}


def queries_dir():
    return "/root/testdata/sf0.01"


def test_pooling_in_blocks_is_whole(monkeypatch):
    model = toxicity.ToxicModel()
    model.vocab = np.arange(1, 50, dtype=np.int32)
    model.embedding = np.random.default_rng(2).normal(size=(50, toxicity.DIM)).astype(np.float32)
    counts = np.array([0, 3, 1, 40, 0, 7])
    buckets = np.random.default_rng(3).integers(0, 60, (counts.sum(), 1 + len(toxicity.PREFIXES))).astype(np.int32)
    whole = model.logits(buckets, counts)
    monkeypatch.setattr(toxicity, "BLOCK", 5)
    assert np.allclose(model.logits(buckets, counts), whole, atol=1e-4)  # single precision
    ends = np.cumsum(counts)
    one = [model.logits(buckets[e - c : e], np.array([c]))[0] for e, c in zip(ends, counts)]
    assert np.allclose(one, whole, atol=1e-4)


def test_quality(spark):
    docs = spark.read.parquet(f"{queries_dir()}/documents.parquet")
    labels = spark.read.parquet(f"{queries_dir()}/labels.parquet")
    ratings = labels.select("doc_id", (F.col("quality") * (2 - F.col("toxic"))).alias("grade"))
    model = quality.train(docs, ratings)
    assert (np.diff(model.cuts) > 0).all()
    rows = quality.rate(docs, model).where(common.held_out(F.col("doc_id"))).join(labels, "doc_id").collect()
    assert np.mean([r.kept == (r.quality == 1) for r in rows]) > 0.9
    odd = documents(spark, [None, "", "ab", "long text " * 200000])
    got = [(r.expected_grade, r.kept) for r in quality.rate(odd, model).orderBy("doc_id").collect()]
    assert got[0] == got[1] and all(0 <= g <= 2 for g, _ in got)
    assert all(r.kept for r in quality.rate(odd, quality.train(docs, ratings.limit(0))).collect())


def test_quality_parts_lose_nothing(monkeypatch):
    texts = [b"", b"ab", b"abc", b"the quick brown fox " * 9, b"xy"]
    whole = np.concatenate([b for _, _, b in quality.trigram_parts(texts)])
    assert len(whole) == sum(max(0, len(t) - 2) for t in texts)
    monkeypatch.setattr(quality, "CHUNK", 7)
    parts = list(quality.trigram_parts(texts))
    assert np.concatenate([b for _, _, b in parts]).tolist() == whole.tolist()
    assert sum(c.sum() for _, c, _ in parts) == len(whole)


def test_sample_of_languages(spark, monkeypatch):
    """At most ``limit`` documents of each language, none lost when there are fewer; repeated rows count once."""
    seen = []
    monkeypatch.setattr(language_id.LanguageModel, "fit", lambda self, texts, y: seen.append((self.languages, texts, y.tolist())) or self)
    repeated = next(i for i in range(5000, 5100) if not common.is_held_out(i))
    rows = [(i, f"word{i} text", "aa") for i in range(3000)] + [(repeated, "same", "bb")] * 500 + [(i, f"text {i}", "cc") for i in range(6000, 6010)]
    rows += [(None, "no id", "dd"), (7, None, "ee"), (8, "x", None), (9001, "long " * 20000, "ff")]
    language_id.train(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"), limit=100)
    names, texts, y = seen[0]
    counts = [y.count(k) for k in range(len(names))]
    free = sum(not common.is_held_out(i) for i in range(6000, 6010))
    assert names == ["aa", "bb", "cc", "dd"] and len(set(texts)) == len(texts)
    assert counts == [100, 1, free, 1]


# 9 licences


def test_whole_licences_with_any_title_and_wrapping(spark):
    texts, wanted = [], []
    for name, body in licenses.TEXTS.items():
        words = body.split()
        for width in (7, 11, 13, 1000):  # words a line, so that lines start anywhere
            lines = "\n".join(" ".join(words[i : i + width]) for i in range(0, len(words), width))
            for title in ["", *licenses.TITLES[name]]:
                texts.append(f"{title.upper()}\n\nCopyright 2020 Jane Doe. All rights reserved.\n(c) Someone\n\n{lines}\n")
                wanted.append(name)
    texts += [licenses.TEXTS["BSD-3-Clause"].replace("1. ", "  * ").replace("2. ", "  * ").replace("3. ", "  - "), licenses.TEXTS["MIT"] + " tail"]
    wanted += ["BSD-3-Clause", None]
    texts.append("MIT License\n" + "long line " * 40000)
    wanted.append(None)
    got = {r.doc_id: r.license for r in licenses.license_scan(documents(spark, texts)).collect()}
    assert [got[i] for i in range(len(texts))] == wanted


def test_licenses(spark):
    mit = "MIT License\n\n" + licenses.TEXTS["MIT"]
    texts = [
        mit.upper().replace("SUBLICENSE", "sub-licence"), mit.replace("MIT License\n", "MIT License\n\nCopyright (c) 2020 Someone\n"),
        "Prose.\nReleased under the MIT Licence\nLicensed under CC BY-NC 4.0.\nReleased under the MIT License.", mit + " More.",
        None, "", "Copyright 2001 X", "prose licensed under CC BY-NC 4.0.",
    ]
    docs = documents(spark, texts).withColumn("license", F.lit(0))
    got = {r.doc_id: (r.license, r.n_notices, r.notices) for r in licenses.license_scan(docs).collect()}
    assert got == {
        0: ("MIT", 0, ""), 1: ("MIT", 0, ""), 2: (None, 3, "CC-BY-NC-4.0,MIT"), 3: (None, 0, ""), 4: (None, 0, ""), 5: (None, 0, ""),
        6: (None, 0, ""), 7: (None, 0, ""),
    }
    assert licenses.license_scan(docs.limit(0)).count() == 0


PUBLISHED = Path("/usr/share/common-licenses")
LONG_FILES = {"Apache-2.0": "Apache-2.0", "GPL-2": "GPL-2.0", "GPL-3": "GPL-3.0", "LGPL-2.1": "LGPL-2.1", "LGPL-3": "LGPL-3.0", "MPL-2.0": "MPL-2.0",
              "CC0-1.0": "CC0-1.0"}


@pytest.mark.skipif(not all((PUBLISHED / f).is_file() for f in LONG_FILES), reason="no published texts here")
def test_long_licences(spark):
    want, texts = [], []
    for file, name in LONG_FILES.items():
        text = (PUBLISHED / file).read_text(encoding="utf-8")
        variants = [text, "  " + text.upper().replace("\n", "\r\n") + "\n\n", text.replace("https:", "http:").replace("Copyright (C) 19", "Copyright (C) 20")]
        end = "END OF TERMS AND CONDITIONS"
        variants += [text.split(end)[0], text.split(end)[0] + end] if end in text else []
        variants += [text[: text.index("Exhibit A - Source")]] if name == "MPL-2.0" else []
        # a list item (c) and a line that begins with "copyright on" are words of the licence
        altered = text.replace("(c) You must retain", "(c) You must drop").replace("copyright on the Program", "copyright on a Program")
        for v in [*variants, text + "More.", altered if altered != text else text[:-40]]:
            texts.append(v)
            want.append(name if v in variants else None)
    got = {r.doc_id: r.license for r in licenses.license_scan(documents(spark, texts)).collect()}
    assert [got[i] for i in sorted(got)] == want


def test_toxicity_learns_from_every_labelled_document(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "SHARD", 100)
    draw = random.Random(8)
    words = [f"word{i}" for i in range(50)]
    # a rude word of its own for each tenth of the documents; texts beyond the former 64 KB take part
    texts = [" ".join(draw.choices(words, k=12)) + (f" rude{i % 10} " if i % 3 == 0 else " kind ") for i in range(3000)]
    texts[3] = texts[3] + "filler " * 12000
    docs = documents(spark, texts)
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(3000)], "doc_id bigint, toxic int")
    rows = toxicity.labelled(docs, labels, "toxic", "doc_id", "text")
    assert sorted(r.text for r in rows.collect()) == sorted(t for i, t in enumerate(texts) if not common.is_held_out(i))
    assert rows.select("shard").distinct().count() > 10
    model = toxicity.train(docs, labels)
    got = toxicity.score(docs, model).where(common.held_out(F.col("doc_id"))).collect()
    assert np.mean([r.predicted == int(r.doc_id % 3 == 0) for r in got]) > 0.98
    again = toxicity.train(docs.repartition(7), labels)
    assert (model.embedding == again.embedding).all() and model.threshold == again.threshold


def test_toxicity_moves_each_text_once(spark, monkeypatch, capsys):
    """One shuffle holds texts, also where the labels are too many to broadcast; repeated ids and rows stay as they are."""
    plans, store = [], toxicity.stored
    for module in (toxicity, toxicity.averaging):
        monkeypatch.setattr(module, "stored", lambda df: plans.append(df) or store(df))
    monkeypatch.setattr(toxicity, "SHARD", 20)
    rows = [(i, f"text {i}") for i in range(200)] + [(i, "again") for i in (1, 1, 2)] + [(3, None), (None, "no id")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in [*range(0, 400, 3), 1, 2]] + [(3, 0), (6, None), (None, 1)], "doc_id bigint, toxic int")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = toxicity.labelled(docs, labels, "toxic", "doc_id", "text")
        next(p for p in plans if "later" in p.columns).explain("formatted")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    exchanges = re.findall(r"\) Exchange\nInput \[\d+\]: (.*)", capsys.readouterr().out)
    assert sum("text#" in x for x in exchanges) == 1
    known = {i: i % 2 for i in [*range(0, 400, 3), 1, 2] if not common.is_held_out(i)}
    want = [(t or "", known[i]) for i, t in rows if i in known]
    assert sorted((r.text, r.label) for r in found.collect()) == sorted(want)
    assert all(len({p.shard for p in found.collect() if p.mix == r.mix}) == 1 for r in found.limit(5).collect())


def test_a_round_reads_shards_by_core(spark, monkeypatch):
    """Many shards, few tasks: their changes are added up before the shuffle."""
    monkeypatch.setattr(toxicity, "SHARD", 20)
    monkeypatch.setattr(toxicity, "ROUNDS", (1, 1))
    seen, means = [], toxicity.averaging.averaged
    monkeypatch.setattr(toxicity.averaging, "averaged", lambda found, table: seen.append(found.rdd.getNumPartitions()) or means(found, table))
    docs = documents(spark, [f"some words {i % 7}" + " rude" * (i % 3 == 0) for i in range(400)])
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(400)], "doc_id bigint, toxic int")
    spark.conf.set("spark.sql.files.openCostInBytes", "128m")  # a task for each file
    try:
        toxicity.train(docs, labels)
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert max(seen) <= spark.sparkContext.defaultParallelism


def test_toxicity_scores_in_small_parts(spark, monkeypatch):
    """However large a batch of texts is, few of them are scored at once; the model's table is laid out once."""
    model = toxicity.ToxicModel().begin(np.arange(1, 100_000))
    run, peaks = [], []
    docs = documents(spark, random_texts(4, 3))
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, f, schema: run.append(f) or self)
    toxicity.drop_toxic(docs, model)
    texts = random_texts(5, 40_000, words=("some", "words", "of", "many", "texts"))
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])
    model.scores([b"tables are made once"])
    for work in (lambda: sum(part.num_rows for part in run[0](iter([batch]))), model.numbers):
        tracemalloc.start()
        try:
            got = work()
            peaks.append(tracemalloc.get_traced_memory()[1])
        finally:
            tracemalloc.stop()
        if len(peaks) == 1:
            assert got == (model.scores([t.encode() for t in texts]) < 0.5).sum()
    assert batch.nbytes > 3 << 20 and peaks[0] < 60 << 20  # what a part needs, and some bytes for each text
    assert got.dtype == np.float32 and peaks[1] < 1.5 * got.nbytes
