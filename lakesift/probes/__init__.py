"""Every operator bound to the test tables, with the SQL that must give the same rows."""

from lakesift.probes.registry import PROBES, Probe, Tables, probe  # noqa: F401


def load_all() -> dict[str, Probe]:
    """Import every binding module and return the probes by key."""
    from lakesift.probes import (  # noqa: F401
        checks,
        columns,
        dedupe,
        facts,
        ingest,
        joins,
        layers,
        measures,
        profile,
        publish,
    )

    return PROBES
