"""Plan shapes shared by the operators: shared-folder checkpoints and skew-proof ordered work."""
