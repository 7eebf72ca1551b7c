"""The registered queries of the core and their SQL."""

from __future__ import annotations

from folioflow.operators import nested, orphans
from folioflow.plans import reference, resolution

QUERIES = {
    "p2_found": nested.p2_found,
    "p2_objects": nested.p2_objects,
    "p2_rejects": nested.p2_rejects,
    "p5_found": orphans.p5_found,
    "p5_report": orphans.p5_report,
    **reference.QUERIES,
    **resolution.QUERIES,
}
SQL = {
    "p2_found": nested.P2_FOUND_SQL,
    "p2_rejects": nested.P2_REJECTS_SQL,
    "p5_found": orphans.P5_FOUND_SQL,
    "p5_report": orphans.P5_REPORT_SQL,
    **reference.SQL,
    **resolution.SQL,
}
