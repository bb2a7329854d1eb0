"""Aliases of released versions, as a small table of state that is replaced as a whole."""

from __future__ import annotations

import json

from millrace.sources.files import FileStore


class RegistryError(RuntimeError):
    """A step that the state doesn't allow."""


class Registry:
    """champion, archived, quarantined and staged versions of one model."""

    def __init__(self, files: FileStore, name: str):
        self.files, self.name = files, f"{name}.registry.json"

    def state(self) -> dict:
        found = self.files.read(self.name)
        return json.loads(found) if found else {"aliases": {}, "versions": {}}

    def _put(self, state: dict) -> None:
        self.files.write(self.name, json.dumps(state, sort_keys=True).encode())

    def register(self, version: str, receipt: dict, sha256: str) -> None:
        """Takes in a version with a receipt that promotes it and, if it names a checksum, has the right one; stages it."""
        if receipt.get("verdict") != "PROMOTED":
            raise RegistryError(f"the verdict on {version} is {receipt.get('verdict')}")
        if receipt.get("sha256") not in (None, sha256):
            raise RegistryError(f"the checksum of {version} isn't the receipt's")
        state = self.state()
        state["versions"][version] = {"sha256": sha256, "state": "staged"}
        state["aliases"]["staged"] = version
        self._put(state)

    def promote(self, version: str) -> None:
        """Makes a version the champion; the one before is archived."""
        state = self.state()
        if version not in state["versions"]:
            raise RegistryError(f"{version} isn't registered")
        before = state["aliases"].get("champion")
        if before and before != version:
            state["aliases"]["archived"] = before
            state["versions"][before]["state"] = "archived"
        if state["aliases"].get("staged") == version:
            del state["aliases"]["staged"]
        state["aliases"]["champion"] = version
        state["versions"][version]["state"] = "champion"
        self._put(state)

    def rollback(self) -> str:
        """Quarantines the champion and brings the archived version back."""
        state = self.state()
        back = state["aliases"].get("archived")
        if not back:
            raise RegistryError("there is no archived version")
        bad = state["aliases"].get("champion")
        if bad:
            state["aliases"]["quarantined"] = bad
            state["versions"][bad]["state"] = "quarantined"
        state["aliases"]["champion"] = back
        state["versions"][back]["state"] = "champion"
        del state["aliases"]["archived"]
        self._put(state)
        return back
