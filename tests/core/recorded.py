"""Recorded answers of a provider."""

calls = {}


def transport(path, page):
    calls[path] = calls.get(path, 0) + 1
    if path.endswith("pulls/3"):
        return 404, []
    if path.endswith("runs") and calls[path] == 1:
        return 503, []
    if path.endswith("commits"):
        objects = [{"id": k, "sha": f"s{k}"} for k in range(230)]
        return 200, objects[(page - 1) * 100 : page * 100]
    return 200, [{"id": 1, "b": 2, "a": "é"}, {"id": 1, "b": 3}]


def endless(path, page):
    return 200, [{"id": page * 1000 + k} for k in range(100)]
