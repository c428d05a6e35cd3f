from __future__ import annotations

import pytest

from millrace.llm import language_id


def test_languages_beyond_the_bound_are_refused_not_left_out(spark, monkeypatch):
    rows = spark.createDataFrame([(i, f"text of {lang}", lang) for i, lang in enumerate(["aa", "bb", "zz"])], "doc_id long, text string, lang string")
    monkeypatch.setattr(language_id, "TEXTS_PER_LANGUAGE", 1)
    monkeypatch.setattr(language_id, "LANGUAGES", 3)
    assert [m[0] for m in language_id.fit_dictionaries(rows)] == ["aa", "bb", "zz"]
    monkeypatch.setattr(language_id, "LANGUAGES", 2)
    with pytest.raises(ValueError):
        language_id.fit_dictionaries(rows)
