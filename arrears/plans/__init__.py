"""Jobs: the snapshot chain, the fact marts, the derived ODS tables, the
table-load specs and the run log."""
