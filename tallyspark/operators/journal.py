"""A journal of a model's answers, and retries, around any client.

Tasks call the model, and Spark may run a task again: after an executor is lost, or beside a slow copy of it. A request
is known by the hash of what it asks; its answer is written to the shared folder before the task goes on, under the hash's name
and by renaming a finished file, so a task that is run again finds the answer and doesn't ask. Two attempts that run
at one moment may both ask; both then use the answer that was there first.

A request that fails is tried again after a delay that grows by ``delay`` with every attempt, up to ``most`` seconds; after
``attempts`` it counts as unanswered, which isn't written down, so a later run asks again.
"""

from __future__ import annotations

import hashlib
import json
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from ..storage import arrow_files
from .tables import NO_TABLES


class Unavailable(Exception):
    """What a client raises for a failure that may pass, such as a rate limit."""


#: Failures after which a request is sent again; the exceptions of HTTP libraries are OSErrors.
PASSING = (Unavailable, OSError, TimeoutError)


def retried(call: Callable[[], object], attempts: int = 3, delay: float = 5.0, most: float = 60.0, sleep: Callable[[float], None] = time.sleep):
    """The call's result, or None where ``attempts`` have failed. Other errors than PASSING are raised."""
    for attempt in range(1, attempts + 1):
        try:
            return call()
        except PASSING:
            if attempt < attempts:
                sleep(min(delay * attempt, most))
    return None


def _hashed(*parts: object) -> str:
    """A hash that tells apart what is asked: each part by its length and bytes."""
    out = hashlib.sha256()
    for part in parts:
        raw = part if isinstance(part, bytes) else json.dumps(part, sort_keys=True, default=str).encode()
        out.update(len(raw).to_bytes(8, "big") + raw)
    return out.hexdigest()


@dataclass(frozen=True)
class Journal:
    """Answers in a folder that all executors share: a path, or a URI that Arrow's filesystems open."""

    path: str

    def get(self, key: str):
        files, root = arrow_files(self.path)
        try:
            with files.open_input_stream(f"{root}/{key[:2]}/{key}.json") as stream:
                return json.loads(stream.read())
        except FileNotFoundError:
            return None

    def put(self, key: str, answer: object) -> object:
        """Write the answer down unless there is one; returns the one that is there."""
        files, root = arrow_files(self.path)
        folder = f"{root}/{key[:2]}"
        files.create_dir(folder, recursive=True)
        draft = f"{folder}/.{key}-{uuid.uuid4().hex}"
        with files.open_output_stream(draft) as stream:
            stream.write(json.dumps(answer).encode())
        if (known := self.get(key)) is not None:
            files.delete_file(draft)
            return known
        files.move(draft, f"{folder}/{key}.json")
        return answer

    def once(self, key: str, ask: Callable[[], object]):
        """The written answer, else what ``ask`` gives, written down unless it is None."""
        answer = self.get(key)
        if answer is None and (answer := ask()) is not None:
            answer = self.put(key, answer)
        return answer


@dataclass(frozen=True)
class JournaledReader:
    """A PageReader that asks ``reader`` once for each batch of pages; unanswered batches count as cut off."""

    reader: object
    path: str
    attempts: int = 3
    delay: float = 5.0

    def read(self, doc_id: str, pages: list[tuple[int, bytes]]) -> tuple[str, str | None]:
        key = _hashed("pages", doc_id, *(x for number, image in pages for x in (number, bytes(image or b""))))
        answer = Journal(self.path).once(key, lambda: retried(lambda: list(self.reader.read(doc_id, pages)), self.attempts, self.delay))
        return (NO_TABLES, None) if answer is None else tuple(answer)


@dataclass(frozen=True)
class JournaledClient:
    """A ModelClient that asks ``client`` once for each set of issues, in whatever order they come; unanswered ones need review."""

    client: object
    path: str
    attempts: int = 3
    delay: float = 5.0

    def verify(self, category: str, issues: list[dict]) -> str:
        issues = sorted(issues, key=lambda i: str(i.get("issue_id")))
        key = _hashed("issues", category, issues)
        return Journal(self.path).once(key, lambda: retried(lambda: self.client.verify(category, issues), self.attempts, self.delay)) or "[]"

    def accounts(self, doc_id: str) -> str:
        return Journal(self.path).once(_hashed("accounts", doc_id), lambda: retried(lambda: self.client.accounts(doc_id), self.attempts, self.delay)) or "[]"
