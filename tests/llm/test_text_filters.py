import hashlib
import math
import random
import re

from tests.llm.conftest import LONG, MESSY

from vellum.llm import decontaminate, licenses, quality, toxicity

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))


def slow_contamination(docs, items):
    out = set()
    for i, t, *_ in docs:
        w = words(t)
        hit, found = set(), set()
        for item, text in items:
            b = words(text)
            n = min(10, len(b))
            grams = {tuple(b[k : k + n]) for k in range(len(b) - n + 1)} if n else set()
            for k in range(len(w) - n + 1 if n else 0):
                if tuple(w[k : k + n]) in grams:
                    hit |= set(range(k, k + n))
                    found.add(item)
        ids = ",".join(sorted(str(x) for x in found if x is not None))
        out.add((i, len(w), len(hit), len(found - {None}), hashlib.sha256(ids.encode()).hexdigest(), bool(hit)))
    return out


def test_windows_of_items(spark, frame):
    r = random.Random(3)
    text = lambda n: " ".join(r.choice("abcde") for _ in range(n))
    items = [(i, text(r.choice([3, 7, 9, 10, 11, 14, 30]))) for i in range(12)] + [(50, None), (51, "..."), (52, "no"), (52, "no id"), (53, "İi ẞ ÉCOLE Σας one two three four five six")]
    rows = MESSY + [(100 + i, text(r.randrange(60))) for i in range(60)]
    rows += [(300 + i, text(4) + "-" + (items[i][1] or "").upper() + "!" + text(3)) for i in range(12)] + [(400, "x " + items[-1][1] + " y")]
    got = decontaminate.contamination(frame(rows), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert len(got) == len(rows)
    assert {tuple(x) for x in got} == slow_contamination(rows, items)


def test_contaminated_documents_go(spark, frame):
    items = spark.createDataFrame([(1, "one two three four five six seven eight nine ten")], "item_id long, text string")
    docs = frame([(1, "one two three four five six seven eight nine ten."), (2, "one two three four five six seven eight nine"), (3, None), (None, "x")])
    kept = decontaminate.clean(docs, items)
    assert kept.columns == docs.columns and sorted(str(r.doc_id) for r in kept.collect()) == ["2", "3", "None"]
    assert decontaminate.clean(docs, items.limit(0)).count() == 4
    assert decontaminate.contamination(frame([]), items).count() == 0


def slow_licenses(t):
    w = words(t)
    places = [(label, i) for label, p in licenses.PHRASES.items() for i in range(len(w)) if w[i : i + len(p.split())] == p.split()]
    base, labels, score = {x for x, _ in places}, {x for x, _ in places}, 1.0 if places else 0.0
    for label, text in licenses.TEMPLATES:
        tw = text.split()
        share = max(len(set(w[i : i + 2 * len(tw)]) & set(tw)) / len(set(tw)) for i in range(0, len(w) + 1, len(tw)))
        if share >= licenses.CONTAINMENT - 1e-9:
            labels.add(label)
            score = max(score, share)
    at = [i for _, i in places]
    return (len(w), len(places), min(at, default=None), max(at, default=None), ",".join(sorted(base)), ",".join(sorted(labels)), score)


def test_licenses(frame):
    r = random.Random(4)
    rows = list(MESSY)
    for i in range(60):
        _, text = r.choice(licenses.TEMPLATES)
        t = [x for x in text.split() if r.random() < r.choice([0.75, 0.9, 1])]
        rows.append((100 + i, " ".join(["filler"] * r.randrange(50) + t + ["end"] * r.randrange(30))))
    rows += [(200, "Under the MIT License. CC BY-NC cc by nc by nc; Apache License, Version 2.0"), (201, "cc by nc"), (202, "under the mit licenses")]
    got = sorted(tuple(str(x) for x in g) for g in licenses.scan(frame(rows)).collect())
    assert got == sorted(tuple(str(x) for x in (i, *slow_licenses(t))) for i, t, *_ in rows)
    assert licenses.scan(frame([])).count() == 0


def labelled(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def corpus(seed=9, n=400):
    r = random.Random(seed)
    stems = ["alpha", "beta", "gamma", "delta", "omega", "sigma"]
    rows, toxic = [], []
    for i in range(n):
        w = [r.choice(stems) + r.choice(["", "n", "ing", "ed"]) for _ in range(r.randrange(5, 80))]
        bad = i % 5 == 0
        if bad:
            w += r.choices(["insultx", "vilena", "vileno", "vilenu"], k=r.randrange(2, 5))
            r.shuffle(w)
        rows.append((i, " ".join(w)))
        toxic.append(bad)
    return rows, toxic


def test_toxic_texts_are_found_on_held_out_rows(spark, frame):
    rows, toxic = corpus()
    labels = labelled(spark, [(i, 1, int(t)) for i, t in enumerate(toxic) if i % 2 == 0] + [(None, 1, 1), (999, 1, None)])
    docs = frame(rows + [(1000, None), (1001, ""), (None, "insultx vilena insultx vileni")])
    got = {r.doc_id: r for r in toxicity.toxicity(docs, labels).collect()}
    assert len(got) == len(rows) + 3
    held_out = [i for i in range(len(rows)) if i % 2]
    assert sum(got[i].toxic != toxic[i] for i in held_out) <= 2
    assert not got[1000].toxic and not got[1001].toxic and got[None].toxic
    assert all(0 <= r.severity <= 2 for r in got.values())
    mean = lambda grade: sum(r.severity for r in got.values() if r.grade == grade) / max(1, sum(r.grade == grade for r in got.values()))
    assert mean(0) < mean(2)
    kept = toxicity.drop_toxic(docs, labels)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if not r.toxic}


def slow_severity(text, weights, thresholds):
    """Expected grade of a text from the fitted weights, in plain Python."""
    has = {f for w in WORD.findall((text or "").lower()) for f in [w] + [w[:n] + "*" for n in (4, 5, 6) if len(w) >= n]}
    s = sum(weights.get(f, 0.0) for f in has)
    upto = [1 / (1 + math.exp(s - t)) for t in thresholds]
    p = [upto[0], upto[1] - upto[0], 1 - upto[1]]
    return p[1] + 2 * p[2], p


def test_features_and_severity_are_those_of_plain_python(spark, frame):
    rows, toxic = corpus(seed=21, n=300)
    messy = [(r[0] and r[0] + 1000, r[1]) for r in MESSY if r[0] is None or r[0] < 5]
    docs = frame(rows + messy + [(400, LONG), (400, LONG), (401, LONG + " insultx vilena")])
    labels = labelled(spark, [(i, 1, int(t)) for i, t in enumerate(toxic)])
    weights, thresholds = toxicity.fit(docs, labels)
    # features: z-scores over the labelled texts, equal texts once
    texts = {}
    for i, t in rows:
        texts[t] = max(texts.get(t, 0), int(toxic[i]))
    counts, totals = ({}, {}), [0, 0]
    for t, y in texts.items():
        totals[y] += 1
        for f in {f for w in WORD.findall(t.lower()) for f in [w] + [w[:n] + "*" for n in (4, 5, 6) if len(w) >= n]}:
            counts[y][f] = counts[y].get(f, 0) + 1
    n0, n1 = totals
    want = set()
    for f in counts[0].keys() | counts[1].keys():
        a, b = counts[1].get(f, 0), counts[0].get(f, 0)
        if 3 <= a + b < n0 + n1:
            share = (a + b) / (n0 + n1)
            if abs(a / n1 - b / n0) / math.sqrt(share * (1 - share) * (1 / n0 + 1 / n1)) >= toxicity.Z:
                want.add(f)
    assert set(weights) == want and thresholds[0] < thresholds[1]
    got = toxicity.score(docs, weights, thresholds).collect()
    assert len(got) == docs.count()
    by_id = {}
    for r in docs.select("doc_id", "text").collect():
        by_id.setdefault(r.doc_id, set()).add(r.text)
    for r in got:
        (text,) = by_id[r.doc_id]
        severity, p = slow_severity(text, weights, thresholds)
        assert abs(r.severity - severity) < 1e-9 and r.toxic == (1 - p[0] >= 0.5)
        assert p[r.grade] >= max(p) - 1e-9
    assert {r.toxic for r in got if r.doc_id == 401} == {True} and {r.toxic for r in got if r.doc_id == 400} == {False}


def test_nothing_to_learn_from(spark, frame):
    rows = [(1, "a b"), (2, "c")]
    for labels in ([], [(1, 1, 1)], [(1, 0, 0), (2, 1, 0)]):
        assert [r.toxic for r in toxicity.toxicity(frame(rows), labelled(spark, labels)).collect()] == [False, False]
    assert toxicity.toxicity(frame([]), labelled(spark, [(1, 1, 1), (2, 1, 0)])).count() == 0


def test_weights_follow_the_labels_and_k_is_exact(spark, frame):
    r = random.Random(10)
    good = [(i, " ".join(r.choices(["fine", "clear", "plain", "prose"], k=30))) for i in range(150)]
    bad = [(1000 + i, " ".join(r.choices(["%%%", "$$", "plain", "##"], k=30))) for i in range(50)]
    labels = labelled(spark, [(i, 1, 0) for i in range(0, 150, 3)] + [(1000 + i, 0, 0) for i in range(0, 50, 3)])
    docs = frame(good + bad + [(5000, None), (5001, "")])
    got = {x.doc_id: x for x in quality.resample(docs, labels, keep=0.7).collect()}
    assert sum(x.kept for x in got.values()) == round(0.7 * 202)
    assert sum(x.kept for i, x in got.items() if 1000 <= i < 2000) == 0
    assert got[5000].log_weight == got[5001].log_weight == 0
    keys = sorted((x.gumbel_key for x in got.values()), reverse=True)
    assert all(x.kept == (x.gumbel_key >= keys[round(0.7 * 202) - 1]) for x in got.values())
    again = {x.doc_id: x.kept for x in quality.resample(docs, labels, keep=0.7).collect()}
    assert again == {i: x.kept for i, x in got.items()}
    assert quality.resample(frame([]), labels).count() == 0
    assert sum(x.kept for x in quality.resample(docs, labels.limit(0)).collect()) == 101


def test_kth_largest_over_many_bins(spark, monkeypatch):
    monkeypatch.setattr(quality, "SORTED", 20)
    r = random.Random(11)
    rows = [(i, r.choice([0.0, 1.0, 2.5, r.random() * 1e6])) for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, key double")
    order = sorted(rows, key=lambda x: (-x[1], x[0]))
    for k in (1, 2, 700, 2500, 3000):
        assert quality.kth_largest(df, "key", "doc_id", k) == (order[k - 1][1], order[k - 1][0])
