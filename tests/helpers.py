from datetime import datetime


def ts(text: str) -> datetime:
    return datetime.fromisoformat(text)


def rows(df, *cols):
    cols = cols or tuple(df.columns)
    return sorted(tuple(r[c] for c in cols) for r in df.collect())
