"""Comparisons that the tests share."""


def multiset(rows) -> list[tuple]:
    return sorted(map(tuple, rows), key=repr)


def texts_of(frame) -> list[tuple]:
    return [(r.doc_id, r.text or "") for r in frame.select("doc_id", "text").collect()]
