"""End-to-end flows a user calls: build a store, query one source, query all of them."""
