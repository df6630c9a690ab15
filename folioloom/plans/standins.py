"""Providers that need no model: what they answer follows from the request, for dry runs and the registered queries."""

from __future__ import annotations

import json
import re
from dataclasses import dataclass

from folioloom.plans.providers import ProviderError, Request


def answer_of_request(request: Request) -> str:
    """A reply that tells what was asked. Raw notes of every seventh book raise, main data of every eleventh is no JSON, publishing of every thirteenth no text."""
    book, n = int(request.book_id), len(request.images)
    if request.analysis == "raw_analysis" and book % 7 == 0:
        raise ProviderError("no notes")
    if request.analysis == "book_main_data" and book % 11 == 0:
        return "I can't tell."
    if request.analysis == "book_pub_and_dist_details" and book % 13 == 0:
        return None
    size = sum(len(data) for _, data in request.images)
    record = {
        "raw_analysis": {"coverPageDescription": f"{n} images of {size} bytes"},
        "book_condition_data": {"Condition": f"c{n % 6 + 1}", "PrintType": " PT2 "},
        "book_content_hints": {"bookNERData": [mime for mime, _ in request.images], "isFiction": n % 2 == 0, "bookBlurbText": f"{request.temperature}", "bookGenre": None},
        "book_main_data": {"published_year": 1900 + n, "title": {"title_in_origin_script": (re.search(r'"coverPageDescription":"([^"]*)"', request.prompt) or ["", "?"])[1]}, "isbn_13": request.book_id},
        "book_pub_and_dist_details": {"image_count": len(re.findall(r"^Image \d+ of", request.prompt, re.M)), "confidence": 0.5, "publisher_name": {"romanized": "P"}},
    }[request.analysis]
    body = json.dumps(record)
    return f"Here it is:\n```json\n{body[:-1]}, // as asked\n}}\n```" if book % 2 else body


class FailingFirst:
    """Fails as often as the prompt says before it answers with the tries and the waits so far."""

    def __init__(self):
        self.tries: dict[str, int] = {}
        self.waited: dict[str, float] = {}
        self.last = ""

    def reply(self, request: Request) -> str:
        self.last = request.book_id
        self.tries[self.last] = self.tries.get(self.last, 0) + 1
        if self.tries[self.last] <= int(request.prompt):
            raise ProviderError("later")
        return f"{self.tries[self.last]} tries, {round(1000 * self.waited.get(self.last, 0))} ms"

    def wait(self, seconds: float) -> None:
        self.waited[self.last] = self.waited.get(self.last, 0) + seconds


@dataclass(frozen=True)
class Named:
    """Answers with its name."""

    name: str

    def reply(self, request: Request) -> str:
        return self.name


@dataclass(frozen=True)
class Member:
    """Answers with what the prompt, a JSON object, has under ``key``; without it, a KeyError."""

    place: int
    key: str

    def reply(self, request: Request) -> str:
        return json.dumps({"answered_by": self.place + 1, "answer": json.loads(request.prompt)[self.key]})
