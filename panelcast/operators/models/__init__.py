"""Model families: trend (SQL-checkable), ridge (additive, direct AR), forest."""
