"""Where the jobs keep their tables."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Store:
    """Table paths under one root folder that all executors can reach."""

    root: str

    def _at(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    @property
    def series(self) -> str:
        return self._at("series")

    @property
    def workouts(self) -> str:
        return self._at("workouts")

    @property
    def sets(self) -> str:
        return self._at("sets")

    @property
    def daily(self) -> str:
        return self._at("daily")

    @property
    def training_sets(self) -> str:
        return self._at("training_sets")

    @property
    def summaries(self) -> str:
        return self._at("summaries")

    @property
    def recent(self) -> str:
        return self._at("recent")

    @property
    def month_parts(self) -> str:
        return self._at("month_parts")

    @property
    def user_means(self) -> str:
        return self._at("user_means")

    def journal(self, job: str) -> str:
        return self._at(f"journal/{job}")

    @property
    def averages(self) -> str:
        return self._at("averages")

    @property
    def payload(self) -> str:
        return self._at("payload")

    @property
    def feed(self) -> str:
        return self._at("feed")

    @property
    def missing_days(self) -> str:
        return self._at("missing_days")

    @property
    def dashboard(self) -> str:
        return self._at("dashboard")

    @property
    def weekly(self) -> str:
        return self._at("weekly")

    @property
    def weeks(self) -> str:
        return self._at("weeks")

    @property
    def documents(self) -> str:
        return self._at("documents")

    @property
    def plans(self) -> str:
        return self._at("plans")

    @property
    def bad_rows(self) -> str:
        return self._at("bad_rows")
