import random

import numpy as np
import pytest
from helpers import rows, table

from lakeweave.llm import ann, common, licenses, toxicity, url_filter

VECTORS = "vec_id long, embedding array<float>, label int, id long, score double, query_id long, rank int"


def vectors(spark, n, dim=8, seed=1):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(20, dim))
    x = (centres[r.integers(0, 20, n)] + 0.3 * r.normal(size=(n, dim))).astype(np.float32)
    x[n // 2 :: 3] = x[0]  # a vector that a sixth of the rows repeat
    data = [(i, [float(v) for v in x[i]]) for i in range(n)]
    odd = [(n + 20, None), (n + 21, [0.0] * dim), (n + 22, [None] + [1.0] * (dim - 1)), (n + 23, [float("nan")] * dim), (n + 40, [float("inf")] + [1.0] * (dim - 1)), (n + 41, [1.0]), (None, [1.0] * dim)]
    return x.astype(float), spark.createDataFrame([(i, v, 1, 2, 3.0, 4, 5) for i, v in data + odd], VECTORS).repartition(3)


def brute(x, i, k):
    s = x @ x[i]
    order = [j for j in np.lexsort((np.arange(len(x)), -s)) if j != i][:k]
    return [(int(j), s[j]) for j in order]


@pytest.mark.parametrize("n", [12, 1500])
def test_neighbours(spark, n):
    x, df = vectors(spark, n)
    got = {}
    for r in ann.search(df, block=100, leaves=24).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert set(got) == set(range(0, n, 20))
    hits = total = 0
    for q, found in got.items():
        found.sort()
        want = brute(x, q, 20)
        assert [r for r, *_ in found] == list(range(1, len(want) + 1))
        assert all(s == pytest.approx(x[v] @ x[q], abs=1e-12) for _, v, s in found)
        assert all((-a[2], a[1]) < (-b[2], b[1]) or a[2] == pytest.approx(b[2]) for a, b in zip(found, found[1:], strict=False))
        hits += len({v for _, v, _ in found} & {v for v, _ in want})
        total += len(want)
    assert hits / total >= 0.9
    assert ann.search(df.limit(0)).collect() == []


def test_scores_and_ties_do_not_depend_on_blocks(spark):
    _, df = vectors(spark, 600)
    got = [sorted(map(tuple, ann.search(d, block=b, asks=a, leaves=8).collect())) for d, b, a in ((df, 7, 3), (df.repartition(5), 2000, 1000), (df.repartition(1), 64, 7))]
    assert got[0] == got[1] == got[2]
    rng = np.random.default_rng(2)
    x, q = rng.normal(size=(300, 64)), rng.normal(size=64)
    assert all((ann.scores(q, x[a:b]) == ann.scores(q, x)[a:b]).all() for a, b in ((0, 1), (0, 7), (5, 300), (100, 228)))


def test_recall_on_queries_that_did_not_set_the_depth(spark):
    x, df = vectors(spark, 6000)
    stats = {}
    got = {}
    for r in ann.search(df, stats=stats).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    others = [q for q in got if q not in set(stats["calibrated_on"])]
    hits = [len(got[q] & {v for v, _ in brute(x, q, 20)}) for q in others]
    assert len(others) > 100 and sum(hits) / (20 * len(hits)) >= 0.9
    assert stats["visits"] < stats["leaves"] / 2  # clustered vectors need few leaves


def test_bins_hold_neighbouring_leaves_up_to_a_block():
    first, many = ann.bins(np.array([5, 5, 30, 4, 0, 4, 4]), 10)
    assert first.tolist() == [0, 0, 1, 4, 4, 4, 5] and many.tolist() == [1, 1, 3, 1, 1, 1, 1]


def labelled():
    r, words = random.Random(2), [f"w{i}" for i in range(200)]
    data = []
    for i in range(600):
        bad = i % 5 == 0
        text = [r.choice(words) for _ in range(r.randint(3, 80))]
        if bad:
            text.insert(r.randrange(len(text)), r.choice(["rotten", "Vile,", "nasty" + r.choice("abcdef")]))
        data.append((i, " ".join(text), "s", int(bad)))
    return data


def test_toxicity(spark):
    data = labelled()
    docs = table(spark, [x[:3] for x in data] + [(i and i + 1000, *x) for i, *x in rows()[40:]])
    labels = spark.createDataFrame([(i, 1, y) for i, _, _, y in data if i < 400] + [(9999, 1, 1), (5, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    model = toxicity.fit(spark, docs, labels)
    got = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got.values()) and len(toxicity.score(docs, model).collect()) == docs.count()
    right = [got[i].predicted == y for i, _, _, y in data if i >= 400]
    assert sum(right) / len(right) > 0.95
    kept = toxicity.reject_toxic(docs, model)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if not r.predicted}
    assert toxicity.fit(spark, docs, labels.where("toxic = 1")) is None
    assert {r.score for r in toxicity.score(docs, None).collect()} == {0.0}
    assert toxicity.score(docs.limit(0), model).collect() == []


def test_logits_equal_a_plain_computation():
    rng = np.random.default_rng(3)
    texts = [rng.integers(0, toxicity.BUCKETS, (n, 3)) for n in (0, 1, 2, 5, 40)]
    model = toxicity.train(texts, np.array([0, 1, 0, 1, 0]), epochs=1)
    for t in texts:
        z, at, f = model.offset, 0, 0
        for width, count in toxicity.FILTERS:
            for j in range(count):
                responses = []
                for w in range(len(t)):
                    total = 0.0
                    for k in range(width):
                        if w + k < len(t):
                            total += sum(float(model.project[b, at + k * count + j]) for b in t[w + k])
                    responses.append(total)
                z += max(max(responses, default=0.0) + float(model.bias[f]), 0) * float(model.weight[f])
                f += 1
            at += width * count
        assert model.logits(t, np.array([0, len(t)]))[0] == pytest.approx(z, abs=1e-4)
    many = model.logits(np.concatenate(texts), np.concatenate([[0], np.cumsum([len(t) for t in texts])]))
    assert many == pytest.approx([model.logits(t, np.array([0, len(t)]))[0] for t in texts], abs=1e-5)


def test_log_ratios_are_plain_counts():
    texts, y = [np.array([[1, 2, 3], [1, 4, 5]]), np.array([[1, 6, 7]]), np.array([[8, 9, 10]])], np.array([1, 0, 0])
    got = toxicity.log_ratios(texts, y)
    assert got[2] == pytest.approx(np.log(((1 + 1 / 3) / 2) / ((0 + 2 / 3) / 3))) and got[8] == 0 and got[100] == 0
    assert got[1] == pytest.approx(np.log(((1 + 1 / 3) / 2) / ((1 + 2 / 3) / 3)))


def test_fitting_is_bounded_by_rows_and_words_and_takes_repeats(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(toxicity, "train", lambda docs, y, real=toxicity.train: seen.append((len(docs), sum(map(len, docs)))) or real(docs, y, epochs=1))
    data = [x[:3] for x in labelled()[:100]]
    docs = table(spark, data + data[:20] + [(None, None, "s")])
    labels = spark.createDataFrame([(i, 1, y) for i, _, _, y in labelled()[:100]] + [(0, 1, 0)], "doc_id long, quality int, toxic int")
    toxicity.fit(spark, docs, labels, sample=15)
    assert seen[0][0] <= 60  # 30 ids, each perhaps twice
    seen.clear()
    toxicity.fit(spark, docs, labels, sample_words=300)
    assert seen and all(words <= 600 for _, words in seen)


def test_fitting_takes_every_labelled_row(spark, monkeypatch):
    data = [(i + 1000 * k, *x) for k in range(19) for i, *x in labelled() if i < 400]  # more than one task's rows and 3,000 of a class
    docs, kinds = table(spark, [x[:3] for x in data] + [x[:3] for x in labelled() if x[0] >= 400]), "doc_id long, toxic int"
    labels = spark.createDataFrame([(i, y) for i, _, _, y in data] + [(10**6, 1), (None, 0)], kinds)
    seen, real = [], toxicity.fit_sharded
    monkeypatch.setattr(toxicity, "fit_sharded", lambda made, sizes, tasks: seen.append((made.count(), sum(n for n, _ in sizes.values()), tasks)) or real(made, sizes, tasks))
    models = [toxicity.fit(spark, docs, labels) for _ in range(2)]
    assert seen == [(len(data), len(data), 2)] * 2 and len(data) > 6000
    assert all((getattr(models[0], x) == getattr(models[1], x)).all() for x in ("project", "bias", "weight", "called"))
    got = {r.doc_id: r.predicted for r in toxicity.score(docs, models[0]).collect()}
    rest = [got[i] == y for i, _, _, y in labelled() if i >= 400]
    assert sum(rest) / len(rest) > 0.95
    # ids of another type, none of which the bitmap may lose
    known = labels.where("doc_id is not null").selectExpr("cast(doc_id as string) _id", "toxic y")
    made = toxicity.labelled_features(docs.selectExpr("cast(doc_id as string) doc_id", "text"), known, 10, "doc_id", "text")
    assert made.count() == len(data)


def test_fitting_with_one_class_in_a_half(spark):
    rows = [(i, int(i in (1, 3)), 3, 0, np.full((3, 3), 5 + 90 * (i in (1, 3)), np.uint16).tobytes()) for i in range(40)]
    made = spark.createDataFrame([(i, y, n, lang, bytearray(b)) for i, y, n, lang, b in rows], "id long, y int, size long, lang int, buckets binary")
    model = toxicity.fit_sharded(made, {(0, 0): (20, 60), (0, 1): (18, 54), (1, 1): (2, 6)}, 2)
    assert np.isfinite(model.project).all() and np.isfinite(model.called).all()


def test_batches_end_at_their_words():
    docs = [np.zeros((n, 3), np.int32) for n in (10, toxicity.BATCH_WORDS + 1, 10, 10, toxicity.BATCH_WORDS - 15)]
    assert [x.tolist() for x in toxicity.parts(np.arange(5), docs)] == [[0], [1], [2, 3], [4]]
    assert [len(x) for x in toxicity.parts(np.arange(130), [docs[0]] * 130)] == [64, 64, 2]


def test_calibration_cuts_in_the_gap():
    x, y = np.array([0.1, 0.2, 3.0, 5.0]), np.array([0, 0, 1, 1])
    assert toxicity.calibrate(x, y, np.ones(4)) == pytest.approx(1.6)


URLS = [None, "", "no scheme", "http://a.example.org/es/1", "https://EXAMPLE.org/en/12?x#y", "http://x.com/fr/2", "http://x.com/de/", "http://org", "http://n.net?q=/fr/", "ftp://a@b.co.uk:80/p#q", "http://192.168.0.1/z", "http://example.org/en/2", "x://y://z/fr"]


def test_rules_and_parts(spark):
    pages = spark.createDataFrame([(i, u, "html", "h", "p") for i, u in enumerate(URLS)], "page_id long, url string, html string, host string, path string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge(pages, labels).collect()}
    assert got[0] == got[1] == got[2] == ("", "", None, "allow")
    assert got[3] == ("a.example.org", "/es/1", "example.org/es/", "block") and got[4] == ("example.org", "/en/12", "example.org/en/1", "block")
    assert got[5][2:] == ("com/fr/", "allow") and got[6][2:] == ("com/de/", "block") and got[7] == ("org", "", None, "allow")
    assert got[8] == ("n.net", "", None, "allow") and got[9][:2] == ("a@b.co.uk:80", "/p") and got[11][2] == "org/" and got[12][0] == "y:"
    assert url_filter.judge(pages.limit(0), labels).collect() == []


def test_reputation_shrinks(spark):
    pages, labels = [], []
    for h, n, bad in [("bad.evil.net", 60, 60), ("one.evil.net", 1, 0), ("good.fine.net", 60, 0), ("new.fine.net", 1, 1)] + [(f"h{i}.site{i}.net", 20, 2) for i in range(10)]:
        for j in range(n):
            pages.append((len(pages), f"http://{h}/{j}"))
            labels.append((len(pages) - 1, int(j >= bad), 0))
    pages.append((len(pages), "http://unseen.evil.net/"))
    got = {r.host: r for r in url_filter.judge(spark.createDataFrame(pages, "page_id long, url string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()}
    assert got["bad.evil.net"].verdict == "block" and got["good.fine.net"].verdict == "allow"
    assert got["new.fine.net"].verdict == "allow"  # one bad page isn't enough against a clean domain
    assert got["unseen.evil.net"].rate > 0.5 and 0.2 < got["new.fine.net"].rate < 0.7


def test_blocked_hosts_equal_the_sql(spark):
    import duckdb

    pages, labels = [], []
    for h, n, bad in [("a.evil.net", 50, 48), ("b.evil.net", 30, 29), ("c.evil.net", 3, 2), ("www.fine.net", 80, 1), ("x.co.uk", 9, 9), ("example.org", 20, 20), ("10.0.0.1", 40, 40), ("q.com", 12, 6)]:
        for j in range(n):
            labels.append((len(pages), int(j >= bad), j % 2 if j < bad else 0))
            pages.append((len(pages), f"http://{h}/{'de' if j % 3 else 'p'}/{j}"))
    pages += [(len(pages) + i, u) for i, u in enumerate(["http://new.evil.net/", "http://new.fine.net/", None, "nothing", "http://lone.io/"])]
    dp, dl = spark.createDataFrame(pages, "page_id long, url string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = url_filter.judge(dp, dl).select("page_id", "host", "path", "rule", "verdict").collect()
    c = duckdb.connect()
    p, k = dp.toArrow(), dl.toArrow()
    c.register("pages", p)
    c.register("labels", k)
    assert sorted(map(tuple, got)) == sorted(map(tuple, c.execute(url_filter.SQL).fetchall()), key=lambda r: r[0])
    by_method = {r.host for r in got if r.rule is None and r.verdict == "block"}
    assert {"a.evil.net", "b.evil.net", "new.evil.net", "10.0.0.1"} <= by_method and not by_method & {"www.fine.net", "new.fine.net", "lone.io"}  # the empty host shares the empty suffix with addresses


def test_hot_hosts_get_their_verdict_too(spark, monkeypatch):
    pages = spark.createDataFrame([(i, f"http://{'hot' if i % 3 else f'h{i}'}.net/{i}") for i in range(200)], "page_id long, url string")
    labels = spark.createDataFrame([(i, 0, 1) for i in range(0, 200, 2)], "doc_id long, quality int, toxic int")
    plain = sorted(map(tuple, url_filter.judge(pages, labels).collect()))
    monkeypatch.setattr(common, "HOT_ROWS", 10)
    monkeypatch.setattr(common, "HOT", 10)
    assert sorted(map(tuple, url_filter.judge(pages, labels).collect())) == plain and len(plain) == 200


def test_domains(spark):
    hosts = ["a.b.example.com", "x.co.uk", "a.x.co.uk", "localhost", "10.0.0.1", "u@a.example.com:80", ""]
    df = spark.createDataFrame([(h,) for h in hosts], "h string").select("h", url_filter.domain_of(url_filter.F.col("h")).alias("d"))
    assert [r.d for r in df.select("d", url_filter.suffix_of(url_filter.F.col("d")).alias("s")).collect()] == ["example.com", "x.co.uk", "x.co.uk", "localhost", "10.0.0.1", "example.com", ""]


def test_licenses(spark):
    data = [(1, "Some text. Released under the MIT License.\nMore.", "s"), (2, "This work is licensed under the GNU General Public License, version 2. Yes.", "s"), (3, "This work is licensed under the GNU General Public License, version 7.", "s"), (4, "no such words", "s"), (5, None, "s"), (6, "A licence to sing.", "s"), (7, "x " * 60_000 + "\nLicensed under CC BY-NC 4.0.", "s"), (8, "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.", "s"), (9, "Licensed under CC BY 4.0.", "s")]
    got = licenses.scan_licenses(table(spark, data)).collect()
    assert {r.doc_id: r.license for r in got} == {1: "MIT", 2: "GPL-2.0", 3: None, 6: None, 7: "CC-BY-NC-4.0", 8: "Apache-2.0", 9: "CC-BY-4.0"}
    at = {r.doc_id: data[r.doc_id - 1][1][r.start : r.start + r.length] for r in got}
    assert "MIT" in at[1] and at[7].startswith("Licensed")
    assert licenses.scan_licenses(table(spark, [])).collect() == []


def plain_place(statement, text):
    """The best place of a statement: of all stretches of the text, the one with the fewest differing words that may differ."""
    a, best = licenses.words(statement), None
    for i in range(len(text)):
        for j in range(i + 1, min(len(text), i + 2 * len(a) + 2) + 1):
            lacks, has = licenses.differences(statement, " ".join(text[i:j]))
            if licenses.confirmed(statement, lacks, has) and (best is None or len(lacks) + len(has) < best):
                best = len(lacks) + len(has)
    return best


def test_places_equal_a_search_of_all_stretches():
    r = random.Random(8)
    short = [s for many in licenses.TEMPLATES.values() for s in many if len(licenses.words(s)) <= 12]
    found = 0
    for _ in range(60):
        s = r.choice(short)
        words = licenses.words(s)
        for _ in range(r.randrange(3)):
            k = r.randrange(len(words))
            words[k : k + 1] = r.choice([[], ["foo"], [words[k], "bar"], ["mit"], ["7"]])
        text = ["some"] * r.randrange(4) + words + ["more"] * r.randrange(4)
        want, got = plain_place(s, text), list(licenses.places(s, text))
        assert (want is None) == (not got), (s, text)
        if got:
            found += 1
            assert min(len(lacks) + len(has) for _, _, lacks, has in got) == want
    assert found > 15


def test_whole_texts_and_short_names_and_repeated_rows(spark):
    t = licenses.TEMPLATES
    data = [(1, "Copyright 2020 X\n\n" + t["BSD-2-Clause"][-1], "s"), (2, "Copyright 2020 X\n\n" + t["BSD-3-Clause"][-1], "s"), (3, "SPDX: GPL-3.0", "s"), (4, "It is Apache-2.0 code.", "s"), (5, t["GPL-2.0"][-1], "s"), (6, t["AGPL-3.0"][-1], "s"), (7, t["ISC"][-1], "s"), (8, "Mit der Bahn, GPL und so weiter", "s"), (3, "SPDX: GPL-3.0", "s"), (3, "SPDX: GPL-3.0", "s"), (9, "See http://www.apache.org/licenses/LICENSE-2.0 there", "s")]
    got = licenses.scan_licenses(table(spark, data)).collect()
    assert sorted((r.doc_id, r.license) for r in got if r.license) == [(1, "BSD-2-Clause"), (2, "BSD-3-Clause"), (3, "GPL-3.0"), (3, "GPL-3.0"), (3, "GPL-3.0"), (4, "Apache-2.0"), (5, "GPL-2.0"), (6, "AGPL-3.0"), (7, "ISC")]


def test_each_statement_is_confirmed_on_itself(spark):
    data = [(f"{a}{s}{b}", name) for name, many in licenses.TEMPLATES.items() for s in many for a, b in (("", ""), ("Some text. ", "\nMore."))]
    data.append(("One.\nThis Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. Two.", "MPL-2.0"))
    got = licenses.scan_licenses(table(spark, [(i, text, "s") for i, (text, _) in enumerate(data)])).collect()
    assert {r.doc_id: r.license for r in got} == {i: name for i, (_, name) in enumerate(data)} and len(got) == len(data)
    r = max(got, key=lambda r: r.doc_id)
    assert data[-1][0][r.start : r.start + r.length] == "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."


def test_all_licenses_of_a_block(spark):
    lines = ["Released under the MIT License.", "Licensed under CC BY 4.0.", "This work is licensed under the GNU General Public License, version 2.", "Licensed under CC BY-SA 4.0."]
    data = [(1, " ".join(lines[:2]), "s"), (2, "\n".join(lines), "s"), (3, "\n\n".join(lines[:3] * 3), "s"), (4, "\n".join(s for many in licenses.TEMPLATES.values() for s in many), "s"), (5, "A licence. " + lines[0], "s")]
    got = licenses.scan_licenses(table(spark, data)).collect()
    want = {1: ["CC-BY-4.0", "MIT"], 2: ["CC-BY-4.0", "CC-BY-SA-4.0", "GPL-2.0", "MIT"], 3: ["CC-BY-4.0", "GPL-2.0", "MIT"], 4: sorted(licenses.TEMPLATES), 5: ["MIT"]}
    assert {i: sorted(r.license for r in got if r.doc_id == i) for i in want} == want
    assert all((r.block, r.start, r.length) == (0, 0, len(data[r.doc_id - 1][1])) for r in got)


def test_wrapped_statements(spark):
    import textwrap

    data = []
    for name, many in licenses.TEMPLATES.items():
        for s in many:
            for width, mark, end in ((75, "", "\n"), (60, " * ", "\n"), (30, "# ", "\n"), (20, "// ", "\r\n"), (12, "", "\n")):
                data.append((f"int x;{end}{mark.strip()}{end}" + "".join(f"{mark}{x}{end}" for x in textwrap.wrap(s, width, break_long_words=False, break_on_hyphens=False)) + f"{mark.strip()}{end}{mark}Other words.{end}", name))
    got = licenses.scan_licenses(table(spark, [(i, text, "s") for i, (text, _) in enumerate(data)])).collect()
    assert {r.doc_id: r.license for r in got} == {i: name for i, (_, name) in enumerate(data)} and len(got) == len(data)
    assert all("Other" not in data[r.doc_id][0][r.start : r.start + r.length] for r in got)
    apart = "A licence to sing.\nNo such word here.\nReleased under\nthe MIT License."
    assert sorted((r.block, r.license or "", apart[r.start : r.start + r.length]) for r in licenses.scan_licenses(table(spark, [(1, apart, "s")])).collect()) == [(0, "", "A licence to sing."), (1, "MIT", "Released under\nthe MIT License.")]
