"""The load steps: feeds to raw zone, raw zone to staging, staging to warehouse."""
