"""A client for the paged source: ten records, three a page."""


def timeline(options, cursor):
    at = int(cursor or 0)
    rows = [(i, f"t{i}") for i in range(at, min(at + 3, 10))]
    return rows, str(at + len(rows)) if rows else None


def records(ids):
    return [{"post_id": i, "text": f"r{i}"} for i in ids if i % 2 == 0]
