"""Ways to hide a word that leave a form of which the channel has more than one reading."""

import numpy as np
import pyarrow as pa
import pytest
from cases import prose
from test_toxicity import BAD, corpus, model  # noqa: F401

from courtlens.llm import toxicity
from courtlens.llm.common import text_buffer
from courtlens.llm.shingles import SPACED, UNCHANGED, find_words

FORMS = {
    "idiot": ["idiiot", "id-iot", "id.iot", "id-io-t", "idio+", "id io t"],
    "moron": ["morron", "mo-ron", "mo.ron", "mo-ro-n", "mo ro n", "MoRRon"],
    "trash": ["trassh", "tra.sh", "tr-ash", "tra$h", "tras#", "tr as h"],
}


def of_text(texts, model):  # noqa: F811
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["_text"])
    hashes, _, owners, _ = toxicity.restored_features(*text_buffer(batch), model, {})
    return [set(hashes[owners == i].tolist()) for i in range(len(texts))]


@pytest.mark.parametrize(("word", "form"), [(w, f) for w, forms in FORMS.items() for f in forms])
def test_forms_count_as_the_word(word, form, model):  # noqa: F811
    whole, hidden = of_text([word, f"ab {prose(1, 5)} {form}"], model)
    batch = pa.RecordBatch.from_arrays([pa.array([word])], ["_text"])
    assert toxicity.features(*text_buffer(batch))[0][0] in whole
    assert toxicity.features(*text_buffer(batch))[0][0] in hidden


def test_words_as_seen_count_too(model):  # noqa: F811
    texts = ["an odd letter-box, well-known!", "as ass", "2024 45 1,000", "", "it is an ox"]
    for text, found in zip(texts, of_text(texts, model)):
        batch = pa.RecordBatch.from_arrays([pa.array([text])], ["_text"])
        assert set(toxicity.features(*text_buffer(batch))[0].tolist()) <= found


@pytest.mark.parametrize("seed", range(4))
def test_every_word_with_another_reading_has_a_lattice(seed):
    rng = np.random.default_rng(seed)
    letters = list("aabbo0$2!+.-*#(é")
    words = ["".join(rng.choice(letters, rng.integers(4, 8))) for _ in range(300)]
    words = [w for w in words if any(c.isalpha() for c in w)]
    data, offsets = text_buffer(pa.RecordBatch.from_arrays([pa.array([" ".join(words)])], ["_text"]))
    starts, ends = toxicity.readable(data, find_words(data, offsets, SPACED, UNCHANGED))
    raw = data.tobytes()
    got = {raw[a:b] for a, b in zip(starts, ends)}
    assert got == {w.encode() for w in words if any(len(o) > 1 for o in toxicity._lattice(w.encode().lower()))}


def test_hidden_rows_are_found(spark):
    rows, labels = corpus()
    hidden = [f for forms in FORMS.values() for f in forms]
    rows += [(10_000 + i, f"{prose(3000 + i, 40, 900)} {w} {prose(4000 + i, 40, 900)}", "x") for i, w in enumerate(hidden)]
    rows += [(20_000 + i, prose(5000 + i, 60, 900), "x") for i in range(50)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, toxic string").repartition(3)
    got = toxicity.score_toxicity(docs, spark.createDataFrame(labels, "doc_id bigint, toxic int")).collect()
    predicted = {r["_id"]: r["predicted"] for r in got}
    assert sum(predicted[10_000 + i] for i in range(len(hidden))) >= 0.8 * len(hidden)
    assert sum(predicted[20_000 + i] for i in range(50)) <= 1
    assert BAD
