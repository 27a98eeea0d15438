"""Validations of whole pairs, and the inventories that list them."""
