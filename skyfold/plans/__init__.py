"""Plans: the flight model wired end to end, reports and audits."""
