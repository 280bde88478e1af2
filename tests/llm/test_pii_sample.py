"""The sample of the PII fit."""

import random

from basketrec.llm import pii


def test_pii_learns_a_rare_kind_beside_a_frequent_one(spark, monkeypatch):
    rng = random.Random(3)
    num = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    texts = [f"see a{num(3)}@ex{num(2)}.org or b{num(3)}@ex{num(2)}.org, ref {num(8)}" for _ in range(1500)]
    texts += [f"call +1 ({num(3)}) {num(3)}-{num(4)} now" for _ in range(60)] + ["call 1 (824) 555-5244 now"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    monkeypatch.setattr(pii, "MAX_SAMPLE", 400)  # 4 of 200 examples would be phones in one draw
    found = pii.findings(df, "doc_id")
    model = pii.train(found)
    out = pii.spans(found, model).filter("doc_id = 1560").first()
    assert {0, 3} <= set(model) and [(x.kind, texts[1560][x.s:x.e]) for x in out.spans] == [(3, "1 (824) 555-5244")]


def test_every_proposal_counts(spark, monkeypatch):
    rng = random.Random(4)
    num = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    texts = [f"see a{num(3)}@ex{num(2)}.org, ref {num(8)}, call +1 ({num(3)}) {num(3)}-{num(4)}" for _ in range(600)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    monkeypatch.setattr(pii, "MAX_CELLS", 50)
    found, counted, real = pii.findings(df, "doc_id"), [], pii._cells
    monkeypatch.setattr(pii, "_cells", lambda rows: counted.append(real(rows)) or counted[-1])
    pii.train(found)
    assert sum(counted[0][0]["n"].to_pylist()) == found.selectExpr("sum(size(loose)) as n").first().n > 1000
