"""Dated input / output locations derived from one anchor date."""

from __future__ import annotations

from dataclasses import dataclass

# Fixed values of the original daily drop: file names of the three inputs.
EXCHANGE_FILE = "quotes_{anchor}.csv"
OTC_FILE = "quotes_mp_month_raw_{anchor}.csv"
BONDS_FILE = "bonds_{anchor}.csv"


@dataclass(frozen=True)
class DatedPaths:
    """Six locations of one daily run. ``input_root`` holds the staged day
    folder; ``output_root`` the metric copies and the stream output. The
    stream checkpoint sits under the day's stream folder, so a new day does
    not resume yesterday's offsets into an empty directory."""

    anchor: str
    input_root: str
    output_root: str
    day_folder: str = "quotes_{anchor}"

    @property
    def _day(self) -> str:
        return f"{self.input_root.rstrip('/')}/{self.day_folder.format(anchor=self.anchor)}"

    @property
    def exchange_quotes(self) -> str:
        return f"{self._day}/{EXCHANGE_FILE.format(anchor=self.anchor)}"

    @property
    def otc_quotes(self) -> str:
        return f"{self._day}/{OTC_FILE.format(anchor=self.anchor)}"

    @property
    def bond_list(self) -> str:
        return f"{self._day}/{BONDS_FILE.format(anchor=self.anchor)}"

    @property
    def metrics_parquet(self) -> str:
        return f"{self.output_root.rstrip('/')}/parquet_{self.anchor}"

    @property
    def metrics_csv(self) -> str:
        return f"{self.output_root.rstrip('/')}/csv_{self.anchor}"

    @property
    def stream_output(self) -> str:
        return f"{self.output_root.rstrip('/')}/stream_{self.anchor}"

    @property
    def stream_checkpoint(self) -> str:
        return f"{self.stream_output}/_checkpoint"

    def all(self) -> dict[str, str]:
        return {k: getattr(self, k) for k in ("exchange_quotes", "otc_quotes", "bond_list",
                                              "metrics_parquet", "metrics_csv", "stream_output")}
