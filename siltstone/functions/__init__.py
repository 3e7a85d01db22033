"""Part of the siltstone engine; see README.md."""
