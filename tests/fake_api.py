"""A transport for tests: pages of invented records."""

CALLS = {"n": 0}


def comments(url, params):
    newest = int(params.get("before", 50))
    return {"data": [{"body": f"comment {t} of {params['subreddit']}", "subreddit": params["subreddit"], "created_utc": t, "score": 1, "id": str(t)} for t in range(newest, max(newest - int(params["size"]), 0), -1)]}


def archive(url, params):
    return {"0": {"posts": [{"com": f"post<br>{params['page']}", "no": params["page"], "time": 5}]}} if params["page"] <= 3 else {"error": "none"}


def videos(url, params):
    n = int(params.get("pageToken", 0))
    item = {"snippet": {"topLevelComment": {"id": f"c{n}", "snippet": {"textDisplay": f"nice &amp; {n}", "publishedAt": "2024-01-01T00:00:00Z", "likeCount": n}}}}
    return {"items": [item]} | ({"nextPageToken": n + 1} if n < 2 else {})


def board(url, params):
    if params["what"] == "catalog":
        return [{"threads": [{"no": 1}, {"no": 2}, {"no": 3}]}]
    return {"posts": [{"com": f"thread {params['no']} reply {i}", "no": params["no"] * 10 + i, "time": i} for i in range(2)]}


def flaky(url, params):
    CALLS["n"] += 1
    if CALLS["n"] < 3:
        raise ConnectionError("busy")
    return {"data": []}


def video_search(url, params):
    if params.get("what") != "search":
        return videos(url, params)
    n = int(params.get("pageToken", 0))
    return {"items": [{"id": {"videoId": f"v{n}"}, "snippet": {"title": f"title {n}"}}]} | ({"nextPageToken": 1} if n == 0 else {})


def board_of_now(url, params):
    CALLS["n"] += 1
    return board(url, params) if params["what"] == "catalog" else {"posts": [{"com": f"call {CALLS['n']}", "no": 1}]}
