from itertools import combinations

from basketrec.llm import jaccard_join
from basketrec.llm.common import importable


def test_near_copies_meet_about_once_a_pair(spark, monkeypatch):
    """Near copies share dozens of tiles, but are rows of the tile join about once a pair, and no link is lost."""
    importable(spark)
    base = [f"w{i}" for i in range(400)]
    texts = [" ".join(base[:30 * k] + [f"changed{k}"] + base[30 * k + 1:]) for k in range(12)]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    meetings, seen = jaccard_join._meetings, []

    def spy(tiles, comp, nodes, num, den):
        found = meetings(tiles, comp.limit(0), nodes, num, den)  # as if no hub had settled any of them
        seen.extend((min(r.a, r.b), max(r.a, r.b)) for r in found.collect())
        return found

    monkeypatch.setattr(jaccard_join, "_meetings", spy)
    rows = jaccard_join.ngram_join(docs).collect()
    assert {r.component_id for r in rows} == {0} and len(rows) == 12
    sids = [jaccard_join.set_id(s) for s in jaccard_join.shingle_sets([t.encode() for t in texts])]
    assert set(seen) == {(min(p), max(p)) for p in combinations(sids, 2)}
    assert len(seen) <= 2 * len(set(seen))
