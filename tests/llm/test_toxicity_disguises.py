"""Disguises that the channel undoes: white space, look-alikes, marks and repeated letters."""

from __future__ import annotations

import numpy as np
import pytest

from rivulet.llm import toxicity

WORDS = "idiot stupid trash moron letter coffee a i am the you are such what an is it person walking market story under little summer book".split()
FORMS = {
    "$ t u p i d": "stupid", "i d ! o t": "idiot", "t r @ s h": "trash", "m o r o n.": "moron", "you a i d i o t I am": "idiot",
    "i  d\ni \t o   t": "idiot", "s. t. u. p. i. d!": "stupid", "t - r - a - s - h": "trash",
    "iiddiioott": "idiot", "mmoorroonn": "moron", "idiiot": "idiot", "1d10t": "idiot",
}


@pytest.fixture(scope="module")
def model():
    return toxicity.CharModel(toxicity._trigrams({w: 400 for w in WORDS}))


@pytest.mark.parametrize("text", FORMS)
def test_read(model, text):
    assert FORMS[text] in {w for t in toxicity.tokens(text) for w in toxicity.readings(t, model)}


def test_look_alikes_alone():
    model = toxicity.CharModel(toxicity._trigrams({"ass": 400, "it": 400}))
    assert "ass" in toxicity.readings("@$$", model) and "ass" in toxicity.readings("4$5", model)


def test_plain_stays(model):
    for w in ("letter", "coffee", "book", "summer"):
        assert toxicity.readings(w, model)[0] == w
    assert toxicity.tokens("1 2 3 4 5") == set("12345") and toxicity.readings("12", model) == []
    assert np.isfinite(model.cost).all()
