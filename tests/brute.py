"""Plain Python versions of the chain and funnel results, for small fixtures."""

from __future__ import annotations

from collections import defaultdict
from datetime import timedelta


def _hour(ts):
    return ts.replace(minute=0, second=0, microsecond=0)


def _users(device, click):
    found = {row["user_custom_id"] for row in device if row["click_id"] == click}
    return found if click is not None and found else {None}


def _key(*values):
    return tuple((value is not None, value) for value in values)


def buy_product(browser, location, device):
    pages = defaultdict(set)
    for row in location:
        pages[row["event_id"]].add(row["page_url_path"])
    groups = defaultdict(set)
    for event in browser:
        if event["event_timestamp"] is None or event["event_id"] is None:
            continue
        for page in pages.get(event["event_id"], ()):
            for user in _users(device, event["click_id"]):
                group = (_hour(event["event_timestamp"]), event["click_id"], user)
                groups[group].add(
                    (event["event_timestamp"], event["event_id"], page, event["event_type"])
                )
    chains, confirmed = [], set()
    for (hour, click, user), members in groups.items():
        ordered = sorted(members, key=lambda m: _key(*m))
        for here, following in zip(ordered, [*ordered[1:], None]):
            after = following[2] if following else None
            if after == "/confirmation":
                confirmed.add((hour, click))
            chains.append((hour, click, user, here, after))
    out = []
    for hour, click, user, here, after in chains:
        page = here[2] or ""
        bought = page.startswith("/product") and len(page) > len("/product")
        if bought and (hour, click) in confirmed and after in ("/cart", "/payment", "/confirmation"):
            rounded = (here[0] + timedelta(milliseconds=500)).replace(microsecond=0)
            out.append((click, user, here[2], rounded, hour))
    return out


def funnel(browser, device, location):
    pages = defaultdict(set)
    for row in location:
        if row["event_id"] is not None:
            pages[row["event_id"]].add(row["page_url_path"])
    groups = defaultdict(set)
    for event in browser:
        if event["event_timestamp"] is None:
            continue
        for page in pages.get(event["event_id"], {None}):
            for user in _users(device, event["click_id"]):
                groups[(_hour(event["event_timestamp"]), user)].add(
                    (event["event_timestamp"], event["event_id"], event["click_id"], page)
                )
    out = []
    for (hour, user), members in groups.items():
        ordered = sorted(members, key=lambda m: _key(*m))
        moves = []
        for here, following in zip(ordered, [*ordered[1:], None]):
            page, after = here[3], following[3] if following else None
            score = 0
            if (page or "")[1:8] == "product" and after == "/cart":
                score = 1
            elif page == "/cart" and after == "/payment":
                score = 2
            elif page == "/payment" and after == "/confirmation":
                score = 3
            if score:
                moves.append((here, after, score))
        kept = []
        for move, following in zip(moves, [*moves[1:], None]):
            here, after, score = move
            next_score = following[2] if following else None
            diff = next_score - score if following else None
            paid = int(after == "/confirmation" and score == 3)
            if diff or paid:
                kept.append((here, after, score, next_score, diff, paid))
        for place, (here, after, score, next_score, diff, paid) in enumerate(kept):
            back = kept[place - 2][0][3] if place >= 2 else None
            out.append(
                (here[2], here[0], user, here[3], after, score, next_score, diff, paid, back, hour)
            )
    return out
