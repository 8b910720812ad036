"""DataFrame operators over snapshots, entities, vehicles and trips."""
