"""Data-lineage analytics on Spark: scripts, job confs and flow exports in, lineage tables out."""
