"""Writers. Each takes one micro-batch (or a whole table) and can be repeated safely."""
