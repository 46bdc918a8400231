"""Options of the log source, with the ones that have no meaning here refused by name."""

from dataclasses import dataclass

FIRST = "FIRST"
NEXT = "NEXT"

_SERVICE = "there is no remote service behind the log; storage access is set on the session"
_WRITER = "micro-batches replace the asynchronous writer; set the trigger interval instead"
REFUSED = {
    "authtoken": _SERVICE,
    "endpoints": _SERVICE,
    "appendretrypolicy": "Spark retries failed tasks itself",
    "maxretries": "Spark retries failed tasks itself",
    "retrydelayms": "Spark retries failed tasks itself",
    "heartbeats": "files need no read session",
    "maxinflightrequests": _WRITER,
    "maxbufferedrequests": _WRITER,
    "maxtimeinbufferms": _WRITER,
    "readsessionbufferbytes": "use maxRecordsPerStream to bound what one micro-batch reads",
    "maxbatchsize": "an append is one batch; batches_by_count cuts rows by number",
    "maxbatchsizeinbytes": "an append is one batch; batches_by_bytes cuts rows by size",
    "maxrecordsizeinbytes": "a sink's bound, not the source's: max_record_bytes of the append functions",
}
KNOWN = {
    "basin",
    "path",
    "streams",
    "discoveryprefix",
    "discoveryintervalms",
    "startbehavior",
    "maxrecordsperstream",
    "recordsperpartition",
    "failondataloss",
    "availablenow",
    # Of the sink; the source reads the stream that a table is written to where it names no other.
    "stream",
    "writer",
    "maxrecordbytes",
}


@dataclass(frozen=True)
class SourceOptions:
    """Where to read. A fixed set of streams wins over a prefix; one of the two is required.

    `max_records_per_stream` bounds a micro-batch. Under the available-now trigger Spark asks the source
    for one batch only, so a cap would leave records unread. The source cannot see the trigger: a cap
    needs `available_now` given, true (the cap is ignored) or false.
    """

    basin: str
    streams: tuple[str, ...] = ()
    discovery_prefix: str | None = None
    discovery_interval_ms: int | None = None
    start_behavior: str = FIRST
    max_records_per_stream: int | None = None
    records_per_partition: int = 250_000
    fail_on_data_loss: bool = True
    available_now: bool | None = None

    def __post_init__(self):
        if not self.basin:
            raise ValueError("basin is required")
        object.__setattr__(self, "streams", tuple(dict.fromkeys(s for s in self.streams if s)))
        if not self.streams and self.discovery_prefix is None:
            raise ValueError("the source needs streams or discoveryPrefix")
        if self.start_behavior not in (FIRST, NEXT):
            raise ValueError(f"startBehavior must be FIRST or NEXT, not {self.start_behavior!r}")
        for name in ("discovery_interval_ms", "max_records_per_stream", "records_per_partition"):
            value = getattr(self, name)
            if value is not None and value < 1:
                raise ValueError(f"{name} must be at least 1, not {value}")

        if self.max_records_per_stream is not None and self.available_now is None:
            raise ValueError("maxRecordsPerStream needs availableNow, true or false: is it the trigger?")

    @property
    def capped(self) -> bool:
        return self.max_records_per_stream is not None and not self.available_now

    @classmethod
    def parse(cls, options: dict[str, str]) -> "SourceOptions":
        given = {k.lower(): v for k, v in options.items()}
        for name in given:
            if name in REFUSED:
                raise ValueError(f"option {name} is not supported: {REFUSED[name]}")
            if name not in KNOWN:
                raise ValueError(f"unknown option {name}")

        named = given.get("streams", "")
        if not named and given.get("discoveryprefix") is None:
            named = given.get("stream") or ""
        streams = tuple(s.strip() for s in named.split(","))

        def number(name):
            return int(given[name]) if given.get(name) else None

        def flag(name, default):
            return str(given.get(name, default)).lower() == "true"

        return cls(
            basin=given.get("basin") or given.get("path") or "",
            streams=streams,
            discovery_prefix=given.get("discoveryprefix"),
            discovery_interval_ms=number("discoveryintervalms"),
            start_behavior=given.get("startbehavior", FIRST).upper(),
            max_records_per_stream=number("maxrecordsperstream"),
            records_per_partition=number("recordsperpartition") or 250_000,
            fail_on_data_loss=flag("failondataloss", True),
            available_now=flag("availablenow", False) if given.get("availablenow") else None,
        )

    def as_reader_options(self) -> dict[str, str]:
        options = {
            "basin": self.basin,
            "streams": ",".join(self.streams),
            "startBehavior": self.start_behavior,
            "recordsPerPartition": str(self.records_per_partition),
            "failOnDataLoss": str(self.fail_on_data_loss).lower(),
        }
        if self.available_now is not None:
            options["availableNow"] = str(self.available_now).lower()
        if self.discovery_prefix is not None:
            options["discoveryPrefix"] = self.discovery_prefix
        if self.discovery_interval_ms:
            options["discoveryIntervalMs"] = str(self.discovery_interval_ms)
        if self.max_records_per_stream:
            options["maxRecordsPerStream"] = str(self.max_records_per_stream)
        return options
