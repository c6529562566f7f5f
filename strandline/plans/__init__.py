"""Statement parsing and the plan from scripts to lineage."""
