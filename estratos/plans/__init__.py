"""Named compositions: cleaned tables, facts and dimensions, reports, and the full run."""
