"""Publication on the driver: write-once objects, staged commits, a pointer that
moves atomically, and verification of what was published."""

from __future__ import annotations

import hashlib
import json
import os
import shutil
import uuid
from contextlib import contextmanager
from pathlib import Path

from chronolith.identity import canonical_json

RESULTS = ("PUBLISHED", "VERIFIED_NO_OP", "QUALITY_BLOCKED", "REJECTED", "FAILED")


class PublicationError(RuntimeError):
    pass


def _write(path: Path, data: bytes) -> None:
    """Bytes on disk before the name appears."""
    path.parent.mkdir(parents=True, exist_ok=True)
    part = path.with_name(f".{path.name}.{uuid.uuid4().hex}")
    with part.open("wb") as f:
        f.write(data)
        f.flush()
        os.fsync(f.fileno())
    os.replace(part, path)


class Store:
    """Objects by digest, commits by identity, and a current pointer by dataset."""

    def __init__(self, root: str | Path):
        self.root = Path(root)

    def put_object(self, data: bytes) -> str:
        """Store once; an existing object must hold the same bytes."""
        digest = hashlib.sha256(data).hexdigest()
        path = self.root / "objects" / digest[:2] / digest
        if path.exists():
            if path.read_bytes() != data:
                raise PublicationError(f"object collision: {digest}")
        else:
            _write(path, data)
        return digest

    def get_object(self, digest: str) -> bytes:
        data = (self.root / "objects" / digest[:2] / digest).read_bytes()
        if hashlib.sha256(data).hexdigest() != digest:
            raise PublicationError(f"object corrupt: {digest}")
        return data

    def publish(self, commit: str, manifest: dict) -> str:
        """Stage, mark and rename a commit; one that stands is verified instead."""
        final = self.root / "commits" / commit
        data = canonical_json(manifest)
        if final.exists():
            if (final / "manifest.json").read_bytes() != data:
                raise PublicationError(f"commit differs: {commit}")
            self.verify(commit)
            return "VERIFIED_NO_OP"
        staging = self.root / "staging" / uuid.uuid4().hex
        _write(staging / "manifest.json", data)
        _write(staging / "COMMITTED", hashlib.sha256(data).hexdigest().encode())
        final.parent.mkdir(parents=True, exist_ok=True)
        try:
            os.rename(staging, final)
        except OSError as error:
            shutil.rmtree(staging, ignore_errors=True)
            raise PublicationError(f"commit was claimed meanwhile: {commit}") from error
        self.verify(commit)
        return "PUBLISHED"

    def verify(self, commit: str) -> dict:
        """The manifest, after its marker, objects and parents were checked."""
        base = self.root / "commits" / commit
        data = (base / "manifest.json").read_bytes()
        if (base / "COMMITTED").read_bytes().decode() != hashlib.sha256(data).hexdigest():
            raise PublicationError(f"marker differs: {commit}")
        manifest = json.loads(data)
        for digest in manifest.get("objects", []):
            self.get_object(digest)
        for parent in manifest.get("parents", []):
            self.verify(parent)
        return manifest

    def set_current(self, dataset: str, commit: str) -> None:
        self.verify(commit)
        _write(self.root / "current" / f"{dataset}.json", canonical_json({"commit": commit}))

    def current(self, dataset: str) -> str | None:
        """The pointer, read again after its commit was verified."""
        path = self.root / "current" / f"{dataset}.json"
        if not path.exists():
            return None
        before = path.read_bytes()
        commit = json.loads(before)["commit"]
        self.verify(commit)
        if path.read_bytes() != before:
            raise PublicationError(f"pointer moved while it was read: {dataset}")
        return commit

    def quarantine(self, data: bytes, reason: dict) -> Path:
        digest = hashlib.sha256(data).hexdigest()
        folder = self.root / "quarantine" / digest
        _write(folder / "data", data)
        _write(folder / "reason.json", canonical_json(reason))
        return folder

    def attempt(self, name: str, result: str, detail: dict) -> None:
        """The record of one attempt, whatever became of it."""
        if result not in RESULTS:
            raise ValueError(f"unknown result {result}")
        _write(self.root / "attempts" / f"{name}.json", canonical_json({"detail": detail, "result": result}))

    @contextmanager
    def lock(self, lane: str):
        """Exclusive by creation; a lane that is locked is an error."""
        path = self.root / "locks" / lane
        path.parent.mkdir(parents=True, exist_ok=True)
        try:
            os.close(os.open(path, os.O_CREAT | os.O_EXCL | os.O_WRONLY))
        except FileExistsError as error:
            raise PublicationError(f"lane is locked: {lane}") from error
        try:
            yield
        finally:
            path.unlink()
