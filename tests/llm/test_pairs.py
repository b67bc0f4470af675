"""The counterfactual penalty sees every sentence that names a group."""

import numpy as np

from placecount.llm import toxicity


def test_late_sentences_are_swapped_too(spark):
    """Groups first named after many sentences about others are unlearnt as well."""
    early = "jews here. " * 12
    rows = [(i, f"{early}women are scum n{i}. about women.", 1) for i in range(120)]
    rows += [(1000 + i, f"{early}men are lovely n{i}. about men.", 0) for i in range(120)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.fit(frame, frame, penalty=toxicity.PENALTY * 100)
    gap = abs(np.subtract(*model.score_all(["women meet here", "men meet here"])))
    plain = toxicity.fit(frame, frame, penalty=0.0)
    assert abs(np.subtract(*plain.score_all(["women meet here", "men meet here"]))) > 0.3
    assert gap < 0.05
