"""Views, business questions, dashboard extracts and end-to-end jobs."""
