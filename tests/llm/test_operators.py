"""Each operator against brute force on small inputs, and on nulls, empty texts, repeats, clashing names and empty tables."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow.fs as pafs
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from docspark.llm import decontamination, embedding_dedup, language_id, licenses, line_dedup, lm_scoring, ngram_join, piece_codec, quality, sampling, token_files
from docspark.llm.graph import connected_components
from docspark.llm.queries import tokenizer_path
from docspark.llm.sampling import in_fold

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, lines string, row int, id int"
WORDS = "the of and house river stone green walks under over bright small table never always seven paper window".split()


def story(seed: int, words: int, per_line: int = 9) -> str:
    r = random.Random(seed)
    out = [r.choice(WORDS) + str(r.randint(0, 400)) for _ in range(words)]
    return "\n".join(" ".join(out[k : k + per_line]) for k in range(0, words, per_line))


def odd_rows():
    long = story(1, 4000)
    edited = long.replace("river", "rivers", 3)
    rows = [(1, long, "en"), (2, edited, "en"), (3, long, "en"), (3, long, "en"), (4, None, None), (5, "", "en"), (6, " \n\n\n ", None), (None, story(2, 40), "en"), (7, "12 34 !!", "en"), (8, "Ein Haus. Ünd!", "de")]
    rows += [(20 + k, story(100 + k, 30), "en") for k in range(6)] + [(40, story(1, 4000)[:900], "en"), (40, story(9, 50), "en")]
    return [(i, t, lang, "s", len(t or ""), "lines", 1, 2) for i, t, lang in rows]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text):
    return (text or "").encode().lower().split()


def test_line_dedup(docs, empty):
    out = line_dedup.dedup_lines(docs)
    assert out.columns == [*docs.columns, "n_lines", "n_removed"]
    rows = out.collect()
    assert len(rows) == docs.count()
    text = {r.doc_id: r for r in rows if r.doc_id not in (None, 40)}
    assert text[1].n_removed == 0 and text[3].text == "" and text[3].n_removed == text[3].n_lines
    kept = text[2].text.split("\n")
    assert 0 < len(kept) < 30 and any("rivers" in x for x in kept)
    assert (text[4].text, text[4].n_lines) == (None, 0) and (text[5].text, text[5].n_lines) == ("", 1)
    assert text[6].text == " \n\n\n "
    assert line_dedup.dedup_lines(empty).count() == 0


def test_line_dedup_overlapping_windows(spark):
    rows = [(1, "a\nb\nc\nd\ne"), (2, "x\nb\nc\nd\ny"), (3, "q\nq\nq\nq\nq"), (4, "c\nd\ne\nz")]
    out = {r.doc_id: r.text for r in line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out == {1: "a\nb\nc\nd\ne", 2: "x\ny", 3: "q", 4: "z"}


def test_lm_scoring(docs, empty):
    path = tokenizer_path("piece_bpe_32k.model")
    rows = lm_scoring.score_texts(docs, path, ~in_fold("doc_id", 7, 2)).collect()
    assert len(rows) == docs.count()
    seen, n = {}, 0
    source = docs.collect()
    for r in source:
        if zlib.crc32(str(r.doc_id if r.doc_id is not None else "").encode()) % 7 != 2:
            for w in [*words(r.text), None]:
                seen[w] = seen.get(w, 0) + 1
                n += 1
    expected = sorted((repr(r.doc_id), len(words(r.text)) + 1, sum(w in seen for w in [*words(r.text), None]), n) for r in source)
    assert sorted((repr(r.doc_id), r.n_tokens, r.n_known, r.train_tokens) for r in rows) == expected
    base = {r.doc_id: sum(math.log10((seen.get(w, 0) + 1) / (n + len(seen) + 1)) for w in [*words(r.text), None]) for r in source if r.doc_id != 40}
    for r in rows:
        assert math.isfinite(r.score) and r.score < 0
        if r.doc_id != 40:
            assert r.base_score == pytest.approx(base[r.doc_id])
    assert lm_scoring.score_texts(empty, path, F.lit(True)).count() == 0


def test_lm_score_is_that_of_the_pieces(docs):
    path = tokenizer_path("piece_bpe_32k.model")
    v = lm_scoring.read_vocabulary(path)
    text = {r.doc_id: r.text for r in docs.collect() if r.doc_id not in (3, 40)}
    fitted = lm_scoring.score_texts(docs, path, ~in_fold("doc_id", 7, 2), mixture=True).collect()
    plain = lm_scoring.score_texts(docs, path, ~in_fold("doc_id", 7, 2), rounds=0).collect()
    for r in plain:  # known words too have nothing but their pieces
        if r.doc_id in text:
            own = [w.decode() for w in words(text[r.doc_id])]
            logs = {own[k]: x for at, codes in lm_scoring.same_length(own) for k, x in zip(at.tolist(), lm_scoring.forward(codes, v)[:, -1], strict=True)} if own else {}
            assert r.score == pytest.approx((sum(logs[w] for w in own) + v.end) / math.log(10))
    assert "mixture_score" not in plain[0] and all(r.score < r.mixture_score < 0 for r in fitted if r.doc_id == 1)


def test_forward_sums_all_segmentations():
    v = lm_scoring.read_vocabulary(tokenizer_path("piece_bpe_32k.model"))
    import sentencepiece

    lib = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model"))

    def score(piece):
        at = v.find(lm_scoring._hash(np.array([[ord(c) for c in piece]], np.uint64), 0, len(piece)))[0]
        assert (at >= 0) == (lib.piece_to_id(piece) > 0 and not lib.is_byte(lib.piece_to_id(piece)))
        return v.score[at] if at >= 0 else v.byte[list(piece.encode())].sum() if len(piece) == 1 else -math.inf

    def total(text):
        return 1.0 if not text else sum(math.exp(score(text[:k])) * total(text[k:]) for k in range(1, min(len(text), 16) + 1))

    for word in ("hello", "thnt,", "日本x", "a", "ünder"):
        (_, codes), = lm_scoring.same_length([word])
        assert lm_scoring.forward(codes, v)[0, -1] == pytest.approx(math.log(total("▁" + word)))


def test_decontamination(spark, docs, empty):
    r = random.Random(5)
    items = [(k, story(500 + k, 25)) for k in range(12)] + [(90, None), (91, "short"), (None, story(7, 20))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = []
    for k in range(60):
        i = r.randrange(12)
        t = list(decontamination.plain(items[i][1]))
        for _ in range(r.randint(0, int(len(t) * 0.16))):
            p = r.randrange(len(t))
            t[p : p + r.randint(0, 1)] = r.choice(["", "x", "y z"])
        rows.append((k, story(900 + k, 60) + "  " + "".join(t).upper() + "\n" + story(1000 + k, 20)))
    rows += [(100, None), (101, ""), (102, items[3][1]), (102, items[3][1]), (None, items[3][1])]
    found = {(x.doc_id, x.item_id): x.edits for x in decontamination.find_items(spark.createDataFrame(rows, "doc_id long, text string"), bench, block=700).collect()}

    def distance(pattern, text):
        row = [0] * (len(text) + 1)
        for i, c in enumerate(pattern):
            new = [i + 1]
            for j, d in enumerate(text):
                new.append(min(row[j] + (c != d), row[j + 1] + 1, new[j] + 1))
            row = new
        return min(row)

    for d, t in rows[:12]:
        text = decontamination.plain(t)
        for i, item in items[:12]:
            pattern = decontamination.plain(item)
            least = distance(pattern, text)
            assert ((d, i) in found) == (least <= len(pattern) // 10)
            if (d, i) in found:
                assert found[d, i] == least
    assert found[102, 3] == 0 and not {(100, 3), (101, 3), (None, 3)} & set(found) and not any(i in (90, 91, None) for _, i in found)
    assert decontamination.find_items(empty, bench).count() == 0 and decontamination.find_items(docs, bench.limit(0)).count() == 0


def test_sentencepiece(docs, empty):
    path = tokenizer_path("piece_bpe_32k.model")
    model = piece_codec.PieceModel(path)
    r = random.Random(2)
    pieces = [p.strip("▁") for p in r.sample(list(model.id), 2000)]
    texts = ["", " ", "\n", "  a  ", "▁a", "a\0b", "日本語 text", "\U0001f600 x"]
    texts += ["".join(r.choice(pieces) for _ in range(r.randint(1, 6))) for _ in range(1500)]
    texts += ["".join(r.choice("abeintshr éü  \n\t▁") for _ in range(r.randint(0, 30))) for _ in range(1500)]
    assert [ids for ids, _ in model.encode(texts)] == model.library.encode(texts)
    out = piece_codec.encode_decode(docs, piece_codec.piece_model(path), ids=True).collect()
    assert len(out) == docs.count()
    source = {(x.doc_id, len(x.text or "")): x.text or "" for x in docs.collect()}
    for x in out:
        text = source[x.doc_id, len(x.decoded)]
        ids = model.library.encode(text)
        assert (x.ids, x.decoded) == (ids, text) and x.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    assert piece_codec.encode_decode(empty, piece_codec.piece_model(path)).count() == 0


def test_sentencepiece_side_by_side(monkeypatch):
    """Distinct words are walked together, not one by one, in little memory; results are the library's on either path."""
    model = piece_codec.PieceModel(tokenizer_path("piece_bpe_32k.model"), memo=500)
    r = random.Random(3)
    words = ["".join(r.choice("etaoinshrdlu\u00e9\n.\0\U0001f600") for _ in range(r.randint(1, 20))) for _ in range(20_000)]
    texts = [" ".join(words[k : k + 100]) for k in range(0, len(words), 100)] + ["x", "  ", "a" * 3000]
    single = []
    walk = piece_codec.PieceModel.backtrack
    monkeypatch.setattr(piece_codec.PieceModel, "backtrack", lambda self, text: single.append(text) or walk(self, text))
    want = model.library.encode(texts)
    assert list(model.encode(texts)) == [(ids, ",".join(map(str, ids))) for ids in want]
    assert len(single) < 200
    for few in (1, 1 << 30):  # all side by side, all one by one
        monkeypatch.setattr(piece_codec, "_FEW", few)
        assert [next(model.encode([t]))[0] for t in texts[-40:]] == want[-40:]
    names = r.sample(sorted(model.usable), 200)
    assert all(model.stay_apart(a, b) == (model.merge(list(a + b)) == [a, b]) for a in names for b in names[:30])


def test_language_id(spark, docs, empty):
    rows = [(k, story(k, 30), "en") for k in range(60)] + [(100 + k, "größe straße und fließt über die brücke " * (k % 5 + 1), "de") for k in range(60)]
    model = language_id.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    out = language_id.predict(docs, model).collect()
    assert len(out) == docs.count() and all(0 <= r.score <= 1 for r in out)
    pred = {r.doc_id: (r.lang_pred, r.score) for r in out}
    assert pred[4] == pred[5] == pred[6] == pred[7] == ("und", 0.0) and pred[1][0] == "en"
    german = spark.createDataFrame([(1, "Die Straße und die Brücke!")], "doc_id long, text string")
    assert language_id.predict(german, model).first().lang_pred == "de"
    none = language_id.train(empty)
    assert {r.lang_pred for r in language_id.predict(docs, none).collect()} == {"und"} and language_id.predict(empty, model).count() == 0


def test_rare_labels_stay_in_the_sample(spark):
    rows = [(k, story(k, 12), "en", 1) for k in range(3000)] + [(5000 + k, "größe straße und fließt über die brücke " * (k % 5 + 1), "de", 0) for k in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, quality int")
    model = language_id.train(df, sample=40)
    german = spark.createDataFrame([(1, "Die Straße und die Brücke!")], "doc_id long, text string")
    assert model.names == ["de", "en"] and language_id.predict(german, model).first().lang_pred == "de"
    sizes = sampling.label_sizes(df, "doc_id", "text", "lang")
    assert sizes == {"en": 3000, "de": 30}
    picked = sampling.bounded(df, "doc_id", "text", "lang", sizes, 1000, 20)
    assert picked.columns == ["doc_id", "text", "lang"] and {r.lang: r["count"] for r in picked.groupBy("lang").count().collect()} == {"en": 990, "de": 20}
    model = quality.train(df, sample=40)
    assert quality.score(german, model).first().score < 0.5 < quality.score(df.limit(1), model).first().score


def test_sample_bounds_rows_of_one_id(spark):
    rows = [(None, story(k, 8), "en") for k in range(900)] + [(7, story(2000 + k % 400, 8), "en") for k in range(900)] + [(8, "x y", "en")] * 900
    rows += [(k, story(k, 8), "de") for k in range(100, 200)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    sizes = sampling.label_sizes(df, "doc_id", "text", "lang")
    assert sizes == {"en": 1301, "de": 100}
    picked = sampling.bounded(df, "doc_id", "text", "lang", sizes, 140, 15).collect()
    assert len(picked) == len(set(picked)) == 130 + 15 and sum(r.lang == "de" for r in picked) == 15
    assert 0 < sum(r.doc_id == 7 for r in picked) < 100 and 0 < sum(r.doc_id is None for r in picked) < 130


def test_token_files(spark, docs, empty):
    from tokenizers import Tokenizer

    path = tokenizer_path("byte_bpe_50k.json")
    library, encode = Tokenizer.from_file(path), token_files.PieceEncoder(path)
    r = random.Random(1)
    texts = ["".join(r.choice(["a", "b", "c é", " ", "  ", "\n", "\t", "'s", "'ll", "1", "<|endoftext|>", "日", " ", "\0", ","]) for _ in range(r.randint(0, 25))) for _ in range(3000)]
    assert [x.tolist() for x in encode(texts)] == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    files = token_files.write_ids(docs, token_files.id_folder(spark), 50257, token_files.piece_encoder(path), end=0)
    out = sorted(token_files.read_ids(files).collect(), key=lambda x: x.start)
    source = {(x.doc_id, len(ids) + 1): [*ids, 0] for x in docs.collect() for ids in [library.encode(x.text or "", add_special_tokens=False).ids]}
    at = 0
    assert [x.doc_id or -1 for x in out] == sorted(x.doc_id or -1 for x in docs.collect())
    for x in out:
        ids = np.array(source[x.doc_id, x.n_tokens], "<u4")
        assert (x.start, x.ids_crc32) == (at, zlib.crc32(ids.tobytes()))
        at += x.n_tokens
    name = files.filter("n_docs > 1").first().file
    system, file = pafs.FileSystem.from_uri(name)
    with system.open_input_file(file) as source_file:
        reader = token_files.Reader(source_file)
        every = [ids.tolist() for *_, ids in reader.documents()]
        assert [reader.document(k).tolist() for k in range(len(every))] == every
    assert token_files.read_ids(token_files.write_ids(empty, token_files.id_folder(spark), 50257, token_files.piece_encoder(path))).count() == 0
    for bits in (1, 5, 8, 16, 17, 32):
        ids = np.random.default_rng(bits).integers(0, 2**bits, 999).astype(np.uint32)
        packed = token_files.pack(ids, bits)
        assert len(packed) == -(-999 * bits // 8) and (token_files.unpack(packed, 999, bits) == ids).all()


def roots(links, ids):
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {i: find(i) for i in ids}


@pytest.mark.parametrize(("size", "percent"), [(3, 90), (5, 80)])
def test_ngram_join(spark, docs, empty, size, percent):
    r = random.Random(size)
    rows = [(x.doc_id, x.text) for x in docs.collect() if x.doc_id is not None]
    base = story(77, 220).split()
    for k in range(60):  # a cloud of near copies, most of them near the base, some only near one another
        w = list(base)
        for _ in range(r.randint(0, 12)):
            w[r.randrange(len(w))] = f"new{r.randint(0, 10**6)}"
        rows.append((300 + k, " ".join(w)))
    for k in range(30):
        w = story(2000 + k // 2, 12).split()
        rows.append((500 + k, " ".join(w[: len(w) - k % 2])))
    out = ngram_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), size=size, percent=percent).collect()
    sets = []
    for i, t in rows:
        w = words(t)
        sets.append((i, frozenset(tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1))) if w else frozenset()))
    links = [(a, b) for a, x in sets for b, y in sets if a < b and x and y and 100 * len(x & y) >= percent * len(x | y)]
    expected = roots(links, [i for i, _ in sets])
    assert sorted((x.doc_id, x.n_shingles, x.component_id) for x in out) == sorted((i, len(s), expected[i]) for i, s in sets)
    assert ngram_join.jaccard_components(empty).count() == 0
    with_null = ngram_join.jaccard_components(docs).filter("doc_id is null").collect()
    assert len(with_null) == 1 and with_null[0].component_id is None


def test_licenses(spark, docs, empty):
    known = licenses.known_digests(spark)
    mit = next(t for name, t in licenses.KNOWN if name == "MIT" and len(t) > 500)
    rows = [(1, "Copyright (c) 2020 A. Person\nAll rights reserved.\n\n" + mit.upper().replace(",", " -")), (2, "x\n  released under the MIT Licence!\ny"), (3, None), (4, ""), (5, "\n \n"), (6, mit[:-10]), (2, "x\n  released under the MIT Licence!\ny"), (None, mit)]
    out = licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string"), known).collect()
    got = sorted((str(x.doc_id), str(x.license), x.line_licenses) for x in out)
    assert got == [("1", "MIT", []), ("2", "None", ["MIT"]), ("2", "None", ["MIT"]), ("3", "None", []), ("4", "None", []), ("5", "None", []), ("6", "None", []), ("None", "MIT", [])]
    assert licenses.scan_licenses(docs, known).count() == docs.count() and licenses.scan_licenses(empty, known).count() == 0
    plan = licenses.scan_licenses(docs, known)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_licenses_as_published(spark):
    texts = dict(licenses.full_texts())
    known = licenses.known_digests(spark, licenses.KNOWN + licenses.full_texts())
    full = {name: next(t for k, t in licenses.KNOWN if k == name and len(t) > 300) for name in ("MIT", "ISC", "0BSD")}
    rows, expected = [], []

    def add(text, license):
        rows.append((len(rows), text))
        expected.append(license)

    for name, text in texts.items():
        add(text, name)
    add("The MIT License (MIT)\n\nCopyright (c) 2020 A. Person\n\n" + full["MIT"], "MIT")
    add("# MIT License\n\nCopyright (c) The Authors\nCopyright A. Person and others\n" + full["MIT"], "MIT")
    add("ISC License\n\nCopyright (c) Isaac Z. Schlueter and Contributors\n\n" + full["ISC"], "ISC")
    add("Copyright (c) <year> <owner>\nAll rights reserved.\n\n" + "\n".join(texts["BSD-3-Clause"].split("\n")[1:]), "BSD-3-Clause")
    add("BSD 2-Clause License\n\nCopyright (c) 2019, A. Person\n" + texts["BSD-2-Clause"], "BSD-2-Clause")
    add(texts["Apache-2.0"].split("APPENDIX")[0], "Apache-2.0")
    add(texts["Apache-2.0"].replace("[yyyy] [name of copyright owner]", "2021 A. Person"), "Apache-2.0")
    add("\n".join(texts["GPL-3.0"].split("\n")[2:]), "GPL-3.0")
    add(texts["GPL-2.0"].split("How to Apply")[0], "GPL-2.0")
    add("MIT License\n\nCopyright (c) The Authors\n", None)
    add("The story\n" + full["MIT"], None)
    add(full["MIT"].replace("The above copyright notice", "MIT License\nThe above copyright notice"), None)
    out = licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string"), known).collect()
    assert {r.doc_id: r.license for r in out} == dict(enumerate(expected))
    table = spark.createDataFrame([("Mine", "My License\nDo as you like.")], "license string, text string")
    own = licenses.scan_licenses(spark.createDataFrame([(1, "my licence\ndo as you like")], "doc_id long, text string"), licenses.known_digests(spark, table))
    assert own.first().license == "Mine"


def test_embeddings(spark):
    rng = np.random.default_rng(3)
    base = rng.standard_normal((12, 16))
    rows, k = [], 0
    for b in range(12):
        for _ in range(1 if b > 5 else 25):
            v = base[b] + rng.standard_normal(16) * 0.12
            rows.append((k, [float(np.float32(x)) for x in v], b % 2))
            k += 1
    rows += [(900, rows[3][1], rows[3][2]), (901, rows[3][1], 1 - rows[3][2]), (902, rows[3][1], None), (903, None, 1), (904, [0.0] * 16, 1), (905, [float("nan")] * 16, 1), (906, [None] * 16, 1), (907, [], 1), (908, [1.0, 2.0], 1), (3, rows[3][1], rows[3][2]), (None, rows[3][1], rows[3][2])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    out = embedding_dedup.link_vectors(df).collect()
    ok = {}
    for i, v, y in rows:
        if i is not None and v and y is not None and None not in v and np.isfinite(v).all() and any(v):
            ok[i] = (np.array(v, np.float32).astype(float), y)
    links = [(a, b) for a, (x, p) in ok.items() for b, (y, q) in ok.items() if a != b and p == q and len(x) == len(y) and x @ y / math.sqrt(x @ x) / math.sqrt(y @ y) >= 0.98]
    assert len(links) > 100
    component = roots([x for x in links if x[0] < x[1]], list(ok))
    expected = [(str(i), sum(a == i for a, _ in links), component.get(i, i), i is not None and component.get(i, i) == i) for i, _, _ in rows]
    assert sorted((str(x.vec_id), x.n_links, x.component_id, x.kept) for x in out if x.vec_id is not None) == sorted(x for x in expected if x[0] != "None")
    assert [(x.n_links, x.component_id, x.kept) for x in out if x.vec_id is None] == [(0, None, False)]
    assert embedding_dedup.link_vectors(df.limit(0)).count() == 0


def test_quality(spark, docs, empty):
    rows = [(k, story(k, 40), 1) for k in range(80)] + [(200 + k, "WIN!! " * (5 + k % 7) + story(k, 6).upper(), 0) for k in range(60)]
    model = quality.train(spark.createDataFrame(rows, "doc_id long, text string, quality int"))
    out = quality.score(docs, model).collect()
    assert len(out) == docs.count() and all(0 <= r.score <= 1 for r in out)
    good = {r.doc_id: r.score for r in out}
    test = quality.score(spark.createDataFrame([(1, story(999, 50)), (2, "WIN!! WIN!! NOW!! " * 9), (3, None)], "doc_id long, text string"), model).collect()
    assert good[1] > 0.7 and test[0].score > 0.7 > test[1].score and 0 <= test[2].score <= 1
    none = quality.train(spark.createDataFrame([], "doc_id long, text string, quality int"))
    assert {r.score for r in quality.score(docs, none).collect()} == {0.5} and quality.score(empty, model).count() == 0


def test_components(spark):
    r = random.Random(4)
    links = [(r.randrange(300), r.randrange(300)) for _ in range(200)] + [(k, k + 1) for k in range(1000, 1100)] + [(5, None), (7, 7)]
    out = {x.node: x.component for x in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    usable = [(a, b) for a, b in links if b is not None and a != b]
    assert out == roots(usable, {i for x in usable for i in x})
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_pipeline_stages(spark, docs, empty, tmp_path):
    folder = str(tmp_path)
    bench = [(1, "every good boy deserves fudge and a very long walk along the quiet river bank today")]
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    extra = [(60, story(60, 30) + "\n" + bench[0][1], "en", "s", 1, "lines", 1, 2)]
    now = docs.unionByName(spark.createDataFrame(extra, SCHEMA))
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, now.limit(0), folder).count() == 0
        now = stage(spark, now, folder).cache()
        kept[name] = {r.doc_id for r in now.select("doc_id").collect()}
        if name != corpus_pipeline.STAGES[-1][0]:
            assert now.columns == docs.columns
    assert not {4, 5, 6, 7} & kept["language_id"] and {1, 2, 3, 20} <= kept["language_id"]
    assert 3 not in kept["line_dedup"] and {1, 20, 60} <= kept["line_dedup"]
    assert {1, 20, 60} <= kept["ngram_jaccard_join"]
    assert 60 not in kept["decontamination"] and {1, 20} <= kept["decontamination"]
    assert kept["sentencepiece"] == kept["decontamination"]


def test_pipeline_keeps_rows_without_id(spark, docs, tmp_path):
    folder = str(tmp_path)
    spark.createDataFrame([(1, "some benchmark item that occurs in none of the documents here")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    odd = [(None, "12 34 !!", "en", "s", 1, "lines", 1, 2), (None, None, None, "s", 0, "lines", 1, 2), (None, story(3, 50), "en", "s", 1, "lines", 1, 2)]
    now = docs.unionByName(spark.createDataFrame(odd, SCHEMA))
    expected = {story(2, 40), story(3, 50)}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, folder).cache()
        assert {r.text for r in now.filter("doc_id is null").collect()} == expected, name
    assert corpus_pipeline.STAGES[-1][1](spark, now, folder).filter("doc_id is null").count() == 2
