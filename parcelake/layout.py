"""Where each layer lives under one root path."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Layout:
    root: str

    def _at(self, *parts: str) -> str:
        return "/".join((self.root.rstrip("/"), *parts))

    def raw(self, kind: str, topic: str) -> str:
        return self._at("raw", kind, topic)

    def bronze(self, kind: str, entity: str) -> str:
        return self._at("bronze", kind, entity)

    def silver(self, kind: str, entity: str) -> str:
        return self._at("silver", kind, entity)

    def gold(self, table: str) -> str:
        return self._at("gold", table)

    def serving(self, table: str) -> str:
        return self._at("serving", table)

    def quality(self, table: str) -> str:
        return self._at("quality", table)

    def live(self) -> str:
        return self._at("live", "shipment_live")

    def live_views(self) -> str:
        return self._at("live", "views")

    def live_due(self) -> str:
        return self._at("live", "due")

    def alerts(self) -> str:
        return self._at("live", "alerts")

    def audit(self) -> str:
        return self._at("audit", "batches")

    def checkpoint(self, query: str) -> str:
        return self._at("checkpoints", query)
