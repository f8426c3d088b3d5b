import re

from feedloom.llm.license_scan import Bands, scan_licenses
from feedloom.llm.license_texts import LICENSE_TEXTS

SCHEMA = "doc_id long, text string, row int, license string, shingle string"


def shingle_set(words):
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(rows, containment=0.8):
    """Every window of every text against every template."""
    out = set()
    for doc_id, text in rows:
        words = [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]
        for name, body in LICENSE_TEXTS:
            want = shingle_set([w for w in re.split(r"[\W_]+", body.lower()) if w])
            size = 8
            while size < max(len(re.findall(r"[^\W_]+", body)), 5):
                size *= 2
            for at in range(0, len(words), size):
                here = {tuple(words[i : i + 5]) for i in range(at, min(at + 2 * size, max(1, len(words) - 4)))}
                if len(want & here) >= containment * len(want):
                    out.add((doc_id, name))
    return out


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, "clash", "clash") for i, t in rows], SCHEMA).repartition(3)


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = {(r["doc_id"], r["license"]) for r in scan_licenses(docs, LICENSE_TEXTS).collect()}
    assert got == brute(rows) and len(got) > 20


def test_odd_rows(spark):
    filler = " ".join(f"word{i}" for i in range(37))
    rows = [(i, f"{filler[: 11 * i]} {body.upper()} {filler}") for i, (_, body) in enumerate(LICENSE_TEXTS)]
    rows += [(100, None), (101, ""), (102, "license"), (103, " ".join(b for _, b in LICENSE_TEXTS)), (104, (filler + " ") * 900 + LICENSE_TEXTS[4][1]), (105, LICENSE_TEXTS[4][1].replace("deal", "trade")), (106, LICENSE_TEXTS[5][1][:60])]
    rows += [(107, LICENSE_TEXTS[0][1] + " x " + filler)] * 3
    got = scan_licenses(frame(spark, rows), LICENSE_TEXTS).collect()
    assert {(r["doc_id"], r["license"]) for r in got} == brute(rows)
    assert len(got) == len({(r["doc_id"], r["license"]) for r in got})
    assert scan_licenses(frame(spark, rows).limit(0), LICENSE_TEXTS).count() == 0


def test_band_settings():
    bands = Bands.for_similarity(0.25, 1e-4)
    assert 1 - bands.collision(0.25) <= 1e-4 < 1 - Bands(bands.bands - 1).collision(0.25)
