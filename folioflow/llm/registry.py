"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from folioflow.llm import canonical, components, leaks, matching, names, survivors, tokens

QUERIES = {
    "p1_found": canonical.p1_found,
    "p1_mapped": canonical.p1_mapped,
    "p1_unmatched": canonical.p1_unmatched,
    "p3_found": names.p3_found,
    "p3_clusters": names.p3_clusters,
    "p4_found": components.p4_found,
    "p4_sizes": components.p4_sizes,
    "p6_found": survivors.p6_found,
    "p6_quality": survivors.p6_quality,
    "p6_values": survivors.p6_values,
    "p7_found": matching.p7_found,
    "p7_pairs": matching.p7_pairs,
    "p7_links": matching.p7_links,
    "p7_members": matching.p7_members,
    "p8_ids": tokens.p8_ids,
    "p8_reuse": tokens.p8_reuse,
    "p9_found": leaks.p9_found,
    "p9_report": leaks.p9_report,
    "p10_pieces": tokens.p10_pieces,
}
SQL = {
    "p6_found": survivors.P6_FOUND_SQL,
    "p4_found": components.P4_FOUND_SQL,
    "p4_sizes": components.P4_SIZES_SQL,
}
