import random
import re

from advisorium.llm import licenses

WORD = re.compile(r"[^\W_]+")


def shingles(text):
    words = WORD.findall(text.lower())
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)}


def brute(texts, templates, least=0.8):
    out = set()
    for number, text in texts:
        for name, template in templates.items():
            wanted = shingles(template)
            if wanted and len(wanted & shingles(text or "")) / len(wanted) >= least:
                out.add((number, name))
    return out


def test_against_whole_texts(docs):
    generator = random.Random(8)
    rows = [(1, None), (2, ""), (3, "under five words"), (None, "x " * 3 + licenses.TEMPLATES["MIT line"])]
    for number, (name, text) in enumerate(licenses.TEMPLATES.items()):
        for copy in range(6):
            words = [f"w{generator.randrange(500)}" for _ in range(generator.randint(0, 300))]
            own = text.split()
            if copy == 5 and len(own) > 40:
                own[0] = "changed"  # a near copy
            at = generator.randint(0, len(words))
            rows.append((100 + 10 * number + copy, " ".join(words[:at] + own + words[at:])))
    rows += [(900, "w " * 30_000 + licenses.TEMPLATES["GPL-3.0 notice"] + " w" * 9_000), (901, rows[10][1]), (901, rows[10][1])]
    got = licenses.scan(docs(rows), segment_words=200).collect()
    assert {(r.doc_id, r.license) for r in got} == brute(rows, licenses.TEMPLATES)
    assert all(r.containment >= 0.8 for r in got) and sum(r.doc_id == 901 for r in got) % 2 == 0
    far = next(r for r in got if r.doc_id == 900)
    assert 29_800 < far.position <= 30_000
    assert licenses.scan(docs(rows).limit(0)).collect() == []


def test_every_document(spark):
    from advisorium.llm.queries import QUERIES
    from tests.conftest import SMALL

    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    got = {(r.doc_id, r.license) for r in QUERIES["op4_licenses"](spark, SMALL).collect()}
    assert got == brute(texts, licenses.TEMPLATES)
