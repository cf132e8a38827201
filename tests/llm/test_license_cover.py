"""Notices that keep 0.8 of their words, wherever the others stand."""

from itertools import combinations

from lexigrid.llm import licenses


def test_notices_at_the_least_cover_are_found(spark):
    texts, want = [], []
    for label, text in licenses.NOTICES:
        own = text.split()
        for lost in combinations(range(len(own)), int(len(own) * 0.2)):
            words = ["other" if i in lost else w for i, w in enumerate(own)]
            texts.append("before it " + " ".join(words) + " after it")
            want.append((label, 1 - len(lost) / len(own)))
    df = spark.createDataFrame(enumerate(texts), "doc_id long, text string")
    got = {r.doc_id: [(f.label, round(f.cover, 9)) for f in r.found if not f.phrase] for r in licenses.license_scan(df).collect()}
    assert len(texts) > 500
    for i, (label, cover) in enumerate(want):
        assert (label, round(cover, 9)) in got[i], (texts[i], got[i])


def test_changed_notices_by_hand(spark):
    mit = licenses.NOTICES[3][1].split()
    mit[9], mit[13] = "one", "two"
    rows = [(1, " ".join(mit)), (2, "released under our mit license"), (3, "under the mit roof")]
    got = dict((r.doc_id, r.found) for r in licenses.license_scan(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert [(f.label, f.cover, f.start, f.end) for f in got[1]] == [("mit", 0.875, 0, 16)]
    assert [(f.label, f.cover, f.start, f.end) for f in got[2]] == [("mit", 0.8, 0, 5)] and got[3] == []
