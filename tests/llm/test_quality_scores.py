"""Quality scores of a whole table, worked out again from compressed sizes, and what the difference of sizes alone is worth."""

import os
import zlib

import numpy as np
import pytest
import zstandard

from phraseloom.llm import common, quality
from phraseloom.llm.queries import op9_quality

DATA = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


def sizes(text, dictionary):
    data = zstandard.ZstdCompressionDict(dictionary)
    packer = zstandard.ZstdCompressor(level=quality.LEVEL, dict_data=data, write_content_size=False, write_checksum=False, write_dict_id=False)
    raw = text.encode()
    return sum(len(packer.compress(raw[at : at + quality.CHUNK])) for at in range(0, len(raw), quality.CHUNK))


def area(scores, labels):
    good, bad = scores[labels == 1], scores[labels == 0]
    return (good[:, None] > bad[None, :]).mean() + (good[:, None] == bad[None, :]).mean() / 2


def test_scores_follow_from_compressed_sizes(spark):
    docs, labels = (common.table(spark, DATA, t) for t in ("documents", "labels"))
    model = quality.train(docs, labels)
    got = {r["doc_id"]: r for r in op9_quality(spark, DATA).collect()}
    truth = {r["doc_id"]: r["quality"] for r in labels.collect()}
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    assert set(got) == set(texts)
    alone, calibrated, held = [], [], []
    for i, text in texts.items():
        raw = len(text.encode())
        g, b = (sizes(text, d) for d in (model.good, model.bad)) if raw else (1, 1)
        difference, ratio = 100 * (b - g) / (b + g), np.log(min(g, b) / raw) if raw else 0.0
        z = float(np.dot(model.weights, (1.0, difference if raw else 0.0, ratio, ratio * ratio)))
        want = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        assert abs(got[i]["score"] - want) < 1e-9 and got[i]["predicted"] == int(want >= quality.THRESHOLD)
        assert got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0)
        if got[i]["held_out"] and truth.get(i) in (0, 1):
            alone.append(difference)
            calibrated.append(got[i]["score"])
            held.append(truth[i])
    held = np.array(held)
    assert 0 < held.sum() < len(held)
    print("AUC on held-out rows: difference alone", area(np.array(alone), held), "calibrated", area(np.array(calibrated), held))
    assert area(np.array(alone), held) > 0.75 and area(np.array(calibrated), held) > 0.9
