"""Use of the stateless columns on streams."""
