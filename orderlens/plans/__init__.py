"""Plan-level composition: materialisation, the end-to-end run, named queries."""
