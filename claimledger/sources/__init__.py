"""Input schemas, readers, and the staging of generic test tables into billing tables."""
