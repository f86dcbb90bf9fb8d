"""Jobs: raw archives -> Silver -> Gold."""
