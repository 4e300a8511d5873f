"""The analytics themselves, one module per subject."""
