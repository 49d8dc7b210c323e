"""DataFrame-to-DataFrame transformations: daily, weekly, snapshots, quality, star."""
