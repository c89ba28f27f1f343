"""The filter audit against applying the filters one after the other."""

import re
from itertools import permutations

from rowmill.llm import audit

DOCS = "doc_id long, text string, source string, n string, mask int"
LABELS = "doc_id long, quality int, toxic int"


def failures(docs):
    out = []
    for i, text, source in docs:
        t = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        out.append((
            i, source or "",
            {
                "A": len(words) < 200,
                "B": 100 * len(set(words)) < 50 * len(words),
                "C": 100 * len(re.findall("[A-Z]", t)) > 2 * len(t),
                "D": bool(re.search(r"[#$%&*|]", t)),
                "E": i is not None and any(j is not None and j < i and (u or "") == t for j, u, _ in docs),
            },
        ))
    return out


def plain(docs, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    failed = failures(docs)
    rows, taken = [], {}
    for part in {p for _, p, _ in failed}:
        for order in permutations("ABCDE"):
            left = [(i, f) for i, p, f in failed if p == part]
            everyone = list(left)
            for step, x in enumerate(order):
                gone = [(i, f) for i, f in left if f[x]]
                left = [(i, f) for i, f in left if not f[x]]
                redundant = sum(f[x] for _, f in everyone) - len(gone)
                alone = sum(f[x] and sum(f.values()) == 1 for _, f in everyone)
                taken[part, x] = taken.get((part, x), 0) + len(gone)
                rows.append([part, "".join(order), step + 1, len(left), len(gone), redundant, alone,
                             sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone), x])
    return sorted((*r[:9], taken[r[0], r[9]]) for r in rows)


def found(spark, docs, labels):
    d = spark.createDataFrame([(*r, "x", 7) for r in docs], DOCS).repartition(3)
    return sorted(tuple(r) for r in audit.report(audit.masks(d, spark.createDataFrame(labels, LABELS))).collect())


def test_as_filters_in_turn(spark):
    many = " ".join(f"w{i}" for i in range(210))
    few = " ".join(f"w{i % 40}" for i in range(205))
    texts = [many, few, many + " 100%", few + " A|B", "ABC def", "", None, "a b \u0085c\x0bd\te", "é" * 60 + "ÀÉ", "x " * 30_000,
             " ".join(f"W{i}" for i in range(250)), "same", "same ", "\U0001f600" * 49 + "A"]
    docs = []
    for i in range(90):
        docs.append((i if i % 17 else None, texts[(i * 7) % len(texts)], [None, "", "web", "news"][i % 4]))
    docs += [docs[3], docs[3], (1000, "same", "hot"), (5, "other text of five", "web"), (5, "same", "web")]
    labels = [(i, i % 2, i % 3 == 0) for i in range(60)]
    labels = [(i, q, int(t)) for i, q, t in labels] + [(None, 1, 1), (2, None, None), (4, 1, None), (4, 0, 1), (4, 1, 0), (777, 1, 1)]
    assert found(spark, docs, labels) == plain(docs, labels)


def test_nothing_and_no_labels(spark):
    assert found(spark, [], []) == []
    docs = [(1, "a", None), (2, "a", "s")]
    assert found(spark, docs, []) == plain(docs, [])


def test_steps_are_least_positions():
    import numpy as np

    orders = np.array(list(permutations(range(3))))
    steps = audit.removal_steps(orders)
    for mask in range(8):
        for at, order in enumerate(orders):
            hit = [s for s, f in enumerate(order) if mask >> f & 1]
            assert steps[mask, at] == (hit[0] if hit else 3)
