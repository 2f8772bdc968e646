"""Raw zone to staging as a file stream."""
