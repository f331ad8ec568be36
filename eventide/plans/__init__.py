"""User-level jobs (the reference's twelve questions) and the query registry."""
