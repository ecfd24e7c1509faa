"""Responses of a made-up server."""

import json


def item(i):
    return {"item_id": i, "item_type": "view_posts", "item_text": f"t{i}"}


def fetch(kind, ident, cursor):
    if kind == "category":
        if cursor is None:
            return json.dumps({"response": {"category": {"category_name": f"C{ident}", "items": [item(10 * ident), item(10 * ident + 1)]}}})
        return json.dumps({"response": {"new_items": [item(10 * ident + cursor)], "no_more_items": cursor >= 3}})
    if kind == "forum":
        times = [t for t in range(9, 0, -1) if cursor is None or t < cursor][:4]
        return json.dumps({"no_more_topics": False, "response": {"topics": [{"topic_id": t, "topic_title": "x", "category_name": "y", "last_post_time": t} for t in times]}})
    return json.dumps({"error_code": "E_NO_PERMISSION"} if ident == 6 else {"response": {"topic": {"posts_data": [{"post_canonical": "a"}]}}})
