"""The fused posterior of every row against one computed in plain Python."""

import math
import random
from collections import Counter, defaultdict

import pytest

from logloom.llm import language_id

BUCKETS = language_id.BUCKETS


def grams(text):
    data = text.lower().encode()
    codes = (data[i] << 16 | data[i + 1] << 8 | data[i + 2] for i in range(len(data) - 2))
    return [(c * 2654435761 % 2**32 >> 8) % BUCKETS for c in codes]


def text_scores(labelled, rows):
    """Per row the log likelihood of its text in each language, in order of names; None without letters."""
    counts = defaultdict(Counter)
    for lang, text in labelled:
        if lang is not None and text is not None:
            counts[lang].update(grams(text))
    names = sorted(counts)
    totals = {lang: sum(c.values()) + BUCKETS / 2 for lang, c in counts.items()}

    def score(text):
        if not text or not any(ch.isalpha() for ch in text):
            return None
        return [sum(math.log((counts[lang][g] + 0.5) / totals[lang]) for g in grams(text)) for lang in names]

    return names, [score(r[1]) for r in rows]


def posterior(labelled, rows, smoothing=language_id.SMOOTHING):
    """``(language, confidence, text language)`` of each ``(id, text, declared, host)``."""
    names, scores = text_scores(labelled, rows)
    n = len(names)
    votes = [None if s is None else s.index(max(s)) for s in scores]
    keys = []
    for _, _, declared, host in rows:
        host = host and host.lower()
        parts = host.split(".") if host else []
        dotted = len(parts) > 1
        keys.append({"declared": declared and declared.lower(), "host": host, "site": ".".join(parts[-2:]) if dotted else None, "suffix": parts[-1] if dotted else None})
    out = []
    for at, key in enumerate(keys):
        def others(name, lang=None, at=at, key=key):
            """Votes of the other rows with the same value."""
            if key[name] is None:
                return 0
            same = (votes[j] for j in range(len(rows)) if j != at and keys[j][name] == key[name])
            return sum(v is not None and lang in (None, v) for v in same)

        evidence = []
        for lang in range(n):
            total = (scores[at][lang] if scores[at] else 0) * language_id.TEXT_WEIGHT
            for name in ("declared", "suffix"):
                if key[name] is not None:
                    of_all = sum(v == lang and k[name] is not None for v, k in zip(votes, keys, strict=True))
                    values = len({k[name] for k in keys} - {None})
                    total += math.log((others(name, lang) + smoothing) / (of_all + smoothing * values))
            whole = (votes.count(lang) + 1) / (sum(v is not None for v in votes) + n)
            site = (others("site", lang) + smoothing * whole) / (others("site") + smoothing)
            total += math.log((others("host", lang) + smoothing * site) / (others("host") + smoothing))
            evidence.append(total)
        known = scores[at] is not None or any(key[c] is not None for c in ("declared", "suffix", "host"))
        best = max(range(n), key=evidence.__getitem__)
        confidence = 1 / sum(math.exp(e - evidence[best]) for e in evidence)
        out.append((names[best], confidence, None if votes[at] is None else names[votes[at]]) if known else (None, 0.0, None))
    return out


def test_posterior_equals_plain_computation(spark):
    rng = random.Random(12)
    words = {"de": "der die und mit nicht ein das ist".split(), "en": "the and with not one that is of".split(), "fr": "le la et avec pas une que est".split()}
    labelled = [(lang, " ".join(rng.choices(words[lang], k=12))) for lang in words for _ in range(8)]
    labelled += [("en", None), (None, "nothing said")]
    rows = []
    for i in range(160):
        lang = rng.choice(list(words))
        text = " ".join(rng.choices(words[lang] + words[rng.choice(list(words))], k=rng.randint(1, 5)))
        text = rng.choice([text] * 7 + [None, "", "12 34"])
        declared = rng.choice([lang, lang.upper(), rng.choice(list(words)), "xx", None])
        host = rng.choice([f"A{rng.randint(0, 3)}.site{rng.randint(0, 2)}.{lang}", f"b.hot.{rng.choice(['org', lang])}", "local", None])
        rows.append((i, text, declared, host))
    rows += rows[:5] + [(999, None, None, None)]
    models = language_id.fit_text_models(spark.createDataFrame(labelled, "lang string, text string"))
    df = spark.createDataFrame(rows, "page_id long, text string, declared string, host string")
    found = language_id.identify(df, models, declared_col="declared", host_col="host", keep=["page_id"]).collect()
    want = defaultdict(list)
    for row, result in zip(rows, posterior(labelled, rows), strict=True):
        want[row[0]].append(result)
    assert len(found) == len(rows)
    for r in found:
        language, confidence, text_language = want[r.page_id].pop()
        assert r.confidence == pytest.approx(confidence, abs=1e-4)
        assert r.text_language == text_language
        if confidence > 0.5001:
            assert r.language == language
        assert r.accepted == (text_language is not None and confidence >= language_id.MIN_CONFIDENCE) or abs(confidence - language_id.MIN_CONFIDENCE) < 1e-4


def test_posterior_of_empty_pages(spark):
    labelled = spark.createDataFrame([("en", "the and"), ("fr", "le et")], "lang string, text string")
    none = spark.createDataFrame([], "page_id long, text string, declared string, host string")
    models = language_id.fit_text_models(labelled)
    assert language_id.identify(none, models, declared_col="declared", host_col="host", keep=["page_id"]).collect() == []
    assert language_id.keep_accepted(none, models, declared_col="declared", host_col="host").count() == 0
