"""Small frames for the corpus operators."""

from __future__ import annotations

DOC = "doc_id bigint, text string, lang string, source string, n_chars bigint"
# Names that operators use inside or return; as extra columns they must not matter.
CLASHING = ("id", "fingerprint", "component_id", "score", "keys", "place", "h1", "n", "label", "words", "spans",
            "block", "term", "start", "ids", "_row", "text_key", "root", "a", "b")


def documents(spark, texts, langs=None, extra=True):
    """One document per text, ids from 0, or (id, text) pairs; with clashing extra columns."""
    pairs = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
    rows = [(i, t, langs[k] if langs else "en", "s", len(t or "")) for k, (i, t) in enumerate(pairs)]
    df = spark.createDataFrame(rows, DOC)
    if extra:
        for name in CLASHING:
            df = df.selectExpr("*", f"cast(null as string) as `{name}`")
    return df


def by_id(df, *columns):
    """Rows as a list of tuples sorted by their text."""
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
