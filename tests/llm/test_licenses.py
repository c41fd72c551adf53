"""License scan: notices told apart by their telling words, whole texts with changes, other texts left alone."""

from __future__ import annotations

import random

from ledgerlens.llm import licenses


def labels(spark, texts, **more):
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r.doc_id: (set(r.labels.split(",")) - {""}, r.base_labels, r.score) for r in licenses.scan(frame, **more).collect()}


def test_notices_of_other_licenses_get_no_label(spark):
    texts = ["This work is released under the GPL license.", "this tool is released under the apache license",
             "licensed under the Mozilla License, version 2.0", "this work is licensed under the GNU Affero General Public License version 3",
             "Your driver's license renewal was released under the new rules of the state, and the mitt is yours.",
             "version 3 of the public general statement is licensed under gnu work this license the", "the word mit alone, released under license the"]
    got = labels(spark, texts)
    assert all(found == (set(), "", 0.0) for found in got.values()), got


def test_notices_are_found(spark):
    pad = " ".join(f"pad{k}" for k in range(90))
    texts = [f"{pad} {t} {pad}" for t in licenses.TEMPLATES.values()]
    got = labels(spark, texts)
    assert all(name in got[k][0] for k, name in enumerate(licenses.TEMPLATES))
    one = labels(spark, [f"{pad} Released, under THE mit License {pad}"])[0]
    assert one[0] == {"mit", "mit-notice"} and one[2] == 1.0


def test_whole_texts_with_changed_words(spark):
    rnd = random.Random(5)
    pad = " ".join(f"pad{k}" for k in range(300))
    texts, want = [], []
    for name, body in licenses.BODIES.items():
        words = body.split()
        for changes in (0, 4, 10):
            own = [*words]
            for k in rnd.sample(range(len(own)), changes):
                own[k] = f"other{k}"
            at = rnd.randrange(250)
            texts.append(" ".join([*pad.split()[:at], *own, *pad.split()[at:]]))
            want.append(name)
        shuffled = rnd.sample(words, len(words))
        texts.append(" ".join(shuffled))  # the same words in another order are no license
        want.append(None)
        texts.append(" ".join(words[:len(words) // 2]))  # half of it is below the bound
        want.append(None)
    got = labels(spark, texts)
    for k, name in enumerate(want):
        found = {x for x in got[k][0] if x in licenses.BODIES}
        assert found == ({name} if name else set()), (k, name, got[k])


def test_templates_of_any_length(spark):
    assert {step: set(own) for step, own in licenses.length_classes({"a": "x " * 24, "b": "x " * 25, "c": "x " * 193}).items()} == {24: {"a"}, 192: {"b"}, 1536: {"c"}}
    rnd = random.Random(6)
    long = " ".join(f"term{rnd.randrange(5000)}" for _ in range(700))
    got = labels(spark, [f"lead {long} tail", long.replace("term1", "word1", 3), "term1 term2"], templates={"house-rules": long}, telling={})
    assert [got[k][0] for k in range(3)] == [{"house-rules"}, {"house-rules"}, set()]
