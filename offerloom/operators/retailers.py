"""Retailer rows: where the known shops' pages hold their fields and lists.

Fixed values: the selectors have to match the shops' pages. What a shop shows by
computed style alone (some names and prices) has no selector; there the generic
cascade gives the field.
"""

from __future__ import annotations

from offerloom.operators.profiles import Record, Rule


def crumbs(at: str, skip: int = 0) -> Record:
    """Breadcrumb links, the first ``skip`` left out."""
    return Record("crumbs", at, (Rule("name", ":scope", required=True), Rule("url", ":scope", take="href", required=True)), skip)


def specs(at: str, key: str, value: str) -> Record:
    """Specification entries with their key and value below each."""
    return Record("specs", at, (Rule("key", key, required=True), Rule("value", value)))


def images(at: str, take: str = "src", cleanup: str = "trim") -> Record:
    return Record("images", at, (Rule("url", ":scope", take=take, cleanup=cleanup, required=True),))


def variants(at: str) -> Record:
    return Record("variants", at, (Rule("url", ":scope", take="href", required=True),))


def cards(at: str, name: str | None, url: str, *more: Rule, take_name: str | None = None) -> Record:
    """Product cards. One without a link keeps its place in the count."""
    named = (Rule("name", name, take=take_name),) if name else ()
    return Record("cards", at, (*named, Rule("url", url, take="href"), *more))


def current(at: str) -> tuple[Rule, ...]:
    """The name of the category that a category page shows."""
    return (Rule("category", at),)


# The shops of one group share their page layout.
_GROUP_RULES = (
    Rule("availability_text", "button[data-test-id='add-to-cart-button']", take="data-test-id"),
    Rule("review_count_text", "div#ratings-section h3 div.lg"),
    Rule("review_score_text", "div#ratings-section h3 div.lc"),
    Rule("description", "main div.ac:has(span:text-is('Produktinformation')) > div"),
    Rule("sku_text", "main div.ac:has(span:text-is('Specifikationer')) div span:nth-of-type(2)"),
)
_GROUP_RECORDS = (
    crumbs("main nav span a", skip=1),
    specs("main div.ac:has(span:text-is('Specifikationer')) tr", "td:nth-child(1)", "td:nth-child(2)"),
    variants("main div.d.a3 ul[role='listbox'] li a"),
)
_GROUP_CARDS = (
    cards("li a[role='article']", None, ":scope", Rule("name", "h3"), Rule("name", "div > div", rank=1)),
    crumbs("main nav span a", skip=1),
)

RULES = {
    "amazon.de": (
        Rule("name", "h1#title", required=True),
        Rule("description", "div#featurebullets_feature_div ul"),
        Rule("brand", "a#bylineInfo"),
        Rule("price_text", "div#buybox #corePrice_feature_div .a-price .a-offscreen"),
        Rule("price_text", "div#buybox #price_inside_buybox", rank=1),
        Rule("price_text", "div#buybox #usedBuySection .offer-price", rank=2),
        Rule("availability_text", "div#buybox #add-to-cart-button", take="value"),
        Rule("review_count_text", "#averageCustomerReviews #acrCustomerReviewText"),
        Rule("review_score_text", "#averageCustomerReviews #acrPopover a > span"),
    ),
    "andlight.dk": (
        Rule("name", "h1[itemprop='name']", required=True),
        Rule("brand", "a#manufacturer-details-link"),
        Rule("brand_url", "a#manufacturer-details-link", take="href"),
        Rule("description", "div[itemprop='description']"),
        Rule("price_text", "span.main-price-padding", required=True),
        Rule("original_price_text", "div.price-before span.line-through"),
        Rule("availability_text", "link[itemprop='availability']", take="href"),
        Rule("gtin", "meta[itemprop='gtin13']", take="content"),
        Rule("sku_text", "span[itemprop='productid']"),
        Rule("mpn", "meta[itemprop='mpn']", take="content"),
    ),
    "baldai1.lt": (
        Rule("name", "h1.pdp-buySection-title", required=True),
        Rule("price_text", ".pdp-buySection .ty-price .ty-price-num", required=True),
        Rule("review_score_text", "div.reviews-section .tf-rating"),
        Rule("review_count_text", "div.reviews-section .tf-based"),
    ),
    "bernomobler.se": (
        Rule("name", "div.product-grid__content .product-single__title", required=True),
        Rule("description", "div.product-grid__content .rte"),
        Rule("price_text", ".product-block--price span", required=True),
    ),
    "bygghemma.se": (
        Rule("name", "h1.mpzBU", cleanup="squash", required=True),
        Rule("description", "div.X9bND div._VQkc > div:nth-child(2)"),
        Rule("price_text", "div.gZqc6 div:first-child > span:first-child", required=True),
        Rule("original_price_text", "div.gZqc6 div:first-child > span:first-child + span:last-child"),
        Rule("brand_url", "div.SonMi a.kkIWz", take="href"),
    ),
    "chilli.se": _GROUP_RULES,
    "connox.dk": (
        Rule("name", "div.product-details h1", required=True),
        Rule("brand", "div.product-details a.product-manufacturer-link", take="title"),
        Rule("brand_url", "div.product-details a.product-manufacturer-link", take="href"),
        Rule("price_text", "div.product-details div.product-price span.price-value", take="data-price-value"),
        Rule("original_price_text", "div.product-details div.product-price span.price-value > s"),
    ),
    "ebuy24.dk": (
        Rule("name", "h1.m-product-title", required=True),
        Rule("description", "div.m-product-additional-info div.description"),
        Rule("price_text", ".m-product-price", required=True),
        Rule("original_price_text", ".m-product-price-before-discount"),
        Rule("sku_text", ".m-product-itemNumber-value"),
        Rule("availability_text", "link[itemprop='availability']", take="href", required=True),
    ),
    "ellos.se": (
        Rule("name", "div.product-desc h1", required=True),
        Rule("brand", "div.product-desc a.brand"),
        Rule("price_text", "div.product-desc strong.offer span:text('SEK')"),
        Rule("original_price_text", "div.product-desc .offer s"),
        Rule("description", "div.product-details-intro"),
        Rule("sku_text", "p.product-details-sku"),
    ),
    "finnishdesignshop.com": (),
    "finnishdesignshop.fi": (),
    "furniturebox.se": _GROUP_RULES,
    "gardenstore.se": (
        Rule("name", "h1.page-title"),
        Rule("description", "div.description"),
        Rule("price_text", "div.product-info-price > div.price-final_price span.price"),
        Rule("price_text", ".price-final_price span.price", rank=1),
        Rule("original_price_text", ".product-info-price span[data-price-type='oldPrice']"),
        Rule("availability_text", ".stock.unavailable", take="class"),
        Rule("review_score_text", ".yotpo-main-widget span.avg-score"),
        Rule("review_count_text", ".yotpo-main-widget span.reviews-qa-label"),
    ),
    "gigameubel.nl": (
        Rule("name", "h1.page-title"),
        Rule("brand", ".sidebar-lg-sticky h4"),
        Rule("description", ".product div.cms-content"),
        Rule("price_text", ".product-info-main span[data-price-type='finalPrice']", required=True),
        Rule("original_price_text", ".product-info-main span[data-price-type='oldPrice']"),
    ),
    "hm.com": (
        Rule("brand", "h2 a"),
        Rule("brand_url", "h2 a", take="href"),
        Rule("description", "#section-descriptionAccordion p"),
    ),
    "homeroom.se": (
        Rule("brand", "h2.long-description-title a:nth-of-type(2)"),
        Rule("brand_url", "h2.long-description-title a:nth-of-type(2)", take="href"),
        Rule("original_price_text", "p.original-price"),
        Rule("price_text", "div.price > p"),
        Rule("availability_text", "button span:text-is('Handla')"),
        Rule("review_score_text", "div.ratings > p > strong"),
        Rule("review_count_text", "div.product-info span.product-rating > a > span"),
        Rule("description", "div.description p"),
    ),
    "jardindeco.com": (
        Rule("name", "div.product_info p.name", required=True),
        Rule("description", "div.product_info div#fdesccourte"),
        Rule("price_text", "div.product_info div#fprixttc", required=True),
        Rule("original_price_text", "div.product_info div.fiche__prices del"),
        Rule("availability_text", "div.product_info div.tags_wrapper > div:text-is('Disponible')"),
        Rule("review_count_text", "div.rating_wrapper .prodratinginfos"),
    ),
    "jensen-company.dk": (
        Rule("name", "div.product-info-main h1.page-title"),
        Rule("brand", "div.product-brand"),
        Rule("sku_text", ".sku div.value"),
        Rule("description", "div.description"),
        Rule("price_text", "div.product-info-main span[data-price-type='finalPrice']"),
        Rule("original_price_text", "div.product-info-main span[data-price-type='oldPrice']"),
    ),
    "k-rauta.se": (
        Rule("brand", "a.product-heading__brand-name"),
        Rule("name", "h1.product-heading__product-name", required=True),
        Rule("description", ".product-info__wrapper div.product-description"),
        Rule("original_price_text", ".product-page__top-info .price-view__before-discount"),
        Rule("price_text", ".product-page__top-info .price-view__sale-price-container", required=True),
        Rule("price_text", ".price-view--large .price-view__sale-price-container", rank=1),
        Rule("availability_text", "span.availability__message"),
        Rule("review_count_text", "div.testfreaks-reviews .tf-based span"),
        Rule("review_score_text", "div.testfreaks-reviews .tf-rating"),
    ),
    "louispoulsen.com": (Rule("name", "div.u-mb-80p h1.u-text-h3-s"),),
    "macys.com": (
        Rule("brand", "label[itemprop='brand'] a.link"),
        Rule("brand_url", "label[itemprop='brand'] a.link", take="href"),
    ),
    "nordiskarum.se": (
        Rule("availability_text", "meta[itemprop='availability']", take="content"),
        Rule("sku_text", ".product__info .product__sku"),
        Rule("original_price_text", ".product__info .sf-price__old"),
        Rule("price_text", ".product__info .sf-price__regular", required=True),
        Rule("price_text", ".product__info .sf-price__special", rank=1),
    ),
    "nordlyliving.dk": (
        Rule("name", "div.product__title:not([style*='display:none']) > h1", required=True),
        Rule("brand", "p.product__text.caption-with-letter-spacing > a[title]"),
        Rule("brand_url", "div.product__description > a", take="href"),
        Rule("description", "div.product__description"),
        Rule("sku_text", "div.product__sku"),
        Rule("price_text", "div.price__sale span.price-item--sale"),
        Rule("price_text", "div.price__regular span.price-item--regular", rank=1),
        Rule("original_price_text", "div.price__sale s.price-item--regular"),
        Rule("availability_text", "div.inventory-text", take="class"),
    ),
    "norliving.dk": (
        Rule("name", ".product h1.product-info__title", required=True),
        Rule("price_text", ".product sale-price", required=True),
        Rule("original_price_text", ".product compare-at-price"),
    ),
    "royaldesign.se": (
        Rule("sale_text", "span.sale.is-pdp"),
        Rule("sku_text", "span.product-sku"),
    ),
    "trademax.se": (
        *_GROUP_RULES,
        Rule("sku_text", "main div:has(h3) div span:nth-of-type(2)", rank=2),
        Rule("review_score_text", "div.accordionRatingContainer > span:nth-of-type(1)", rank=1),
        Rule("review_count_text", "div.accordionRatingContainer > span:nth-of-type(2)", rank=1),
    ),
    "trendrum.se": (
        Rule("name", "div.infodisplay_headerbox h1"),
        Rule("description", "div.products_description span"),
        Rule("price_text", "div.productPrices span.currentprice"),
        Rule("price_text", ".productPrices span.currentprice", rank=1),
    ),
    "unoliving.com": (
        Rule("brand", ".product-info-main h2.pdp__brand__title"),
        Rule("price_text", ".product-info-main span[data-price-type='finalPrice']", take="data-price-amount", required=True),
        Rule("original_price_text", ".product-info-main span[data-price-type='oldPrice']", take="data-price-amount"),
    ),
    "venturedesign.se": (
        Rule("name", "div.article-detail-text h1", required=True),
        Rule("description", "div.container:has(> div.label:text('beskrivning')) > div.content"),
        Rule("gtin", "h6:text-is('GTIN:') ~ span"),
        Rule("sku_text", "h6:text-is('Artikelnr:') ~ span"),
    ),
    "wayfair.de": (
        Rule("name", "div[data-enzyme-id='PdpLayout-infoBlock'] header h1", required=True),
        Rule("brand", "div[data-enzyme-id='PdpLayout-infoBlock'] a[data-enzyme-id='pdp-title-block-manufacturer-name']"),
        Rule("description", "div.ProductOverviewItem .ProductOverviewInformation-content"),
        Rule("original_price_text", "div[data-enzyme-id='PdpLayout-infoBlock'] div[data-enzyme-id='PriceBlock'] s"),
        Rule("price_text", "div[data-enzyme-id='PdpLayout-infoBlock'] div[data-enzyme-id='PriceBlock'] span:first-child", required=True),
        Rule("availability_text", ".OutOfStockOverlay", take="class"),
        Rule("sku_text", ".PdpLayoutResponsive-breadcrumbWrap nav li:last-child"),
        Rule("review_score_text", "div[data-enzyme-id='PdpLayout-infoBlock'] .ProductRatingNumberWithCount-rating"),
        Rule("review_count_text", "div[data-enzyme-id='PdpLayout-infoBlock'] .ProductRatingNumberWithCount-count"),
    ),
}
RULES["finnishdesignshop.com"] = RULES["finnishdesignshop.fi"] = (
    Rule("name", "h1[itemprop='name']", required=True),
    Rule("brand", "div.product-info-col h2 > a"),
    Rule("description", "div.product-description:not(.hidden)"),
    Rule("price_text", "div.price-container span.price-localized > span:nth-of-type(1)"),
    Rule("price_text", "form span#price span.price-localized", rank=1),
    Rule("original_price_text", "form span#price span.price-original"),
    Rule("sku_text", "form span#price span.price-localized", take="data-sku"),
    Rule("availability_text", "span.sku-availability.bg-checkmark", take="class"),
)

RECORDS = {
    "amazon.de": (
        crumbs("div#wayfinding-breadcrumbs_container li a"),
        specs("div#prodDetails table#productDetails_techSpec_section_1 tr", "th", "td"),
        specs("div#prodDetails table#productDetails_detailBullets_sections1 tr", "th", "td"),
        images("div.imgTagWrapper img"),
    ),
    "andlight.dk": (
        crumbs("a.BreadCrumbLink"),
        specs("div.productdetails-flex-row", "div:nth-of-type(1)", "div:nth-of-type(2)"),
        images("div#product-info div.prod-image a", take="href"),
        variants("section.variants a.productElement"),
    ),
    "baldai1.lt": (
        crumbs("div.ty-breadcrumbs a", skip=1),
        specs("div#product_tab_features .ty-product-feature_label", ":scope", ":scope ~ .ty-product-feature_value"),
        images(".owl-item > a > img.ty-pict"),
        variants("div.pdp-bs-variationsItemContent a"),
    ),
    "bygghemma.se": (
        crumbs("a.PMDfl"),
        specs("div.OeTqb table tr", "th", "td"),
        images("img.vGPfg"),
        images("img.eNbZA"),
    ),
    "chilli.se": _GROUP_RECORDS,
    "connox.dk": (
        crumbs("section.breadcrumb ul#breadcrumb li a", skip=1),
        specs("section#product-properties div.accordion__item table tr", "td:first-child", "td:last-child"),
        images("div.product-gallery img"),
        variants("div.product-variant-selection a"),
    ),
    "ebuy24.dk": (
        crumbs("div.m-breadcrumb a", skip=1),
        specs("div.m-product-customdata table tr", "td.m-product-customdata-title", "td.m-product-customdata-data"),
    ),
    "ellos.se": (crumbs("ul.navigation-breadcrumb-items li a[href]"), variants("div.product-info ul.color-picker-list a")),
    "finnishdesignshop.fi": (
        crumbs("ol.breadcrumb a", skip=1),
        specs("dl.product-features-list dt", ":scope", ":scope + dd"),
        images("img.product-large-image"),
    ),
    "furniturebox.se": _GROUP_RECORDS,
    "gardenstore.se": (
        crumbs("div.breadcrumbs li a", skip=1),
        specs("table.additional-attributes tr", "th", "td"),
        images("div.fotorama__stage__frame img"),
    ),
    "gigameubel.nl": (crumbs("div.breadcrumbs ul li a", skip=1),),
    "hm.com": (
        crumbs("nav[aria-label='Breadcrumb'] li a"),
        specs("div#section-descriptionAccordion dl dt", ":scope", ":scope + dd"),
        images("[data-testid='grid-gallery'] img"),
    ),
    "homeroom.se": (
        crumbs("ul.breadcrumbs > li > a"),
        Record("reviews", "ul.review-list > li", (Rule("score_text", ".stars-filled", take="style", cleanup="after_colon"), Rule("content", ".review-text"))),
    ),
    "jardindeco.com": (
        crumbs("div.breadcrumbprod.hidden-md a"),
        specs("div.tab_collection_area div.tbl_caracs_tr", "div:first-child", "div:last-child"),
        images("#gallery_imgs img"),
    ),
    "jensen-company.dk": (crumbs("div.breadcrumbs ul li a", skip=1), images(".fotorama__thumb img")),
    "k-rauta.se": (crumbs("div.product-page__breadcrumbs a"), specs("dt", ":scope", ":scope + dd")),
    "louispoulsen.com": (images(".slider-image", take="srcset"), images(".inspirational-content img")),
    "macys.com": (crumbs("nav.breadcrumbs a.p-menuitem-link"),),
    "nordiskarum.se": (
        crumbs("li.sf-breadcrumbs__list-item a:not(.sf-breadcrumbs__breadcrumb--current)", skip=1),
    ),
    "nordlyliving.dk": (images("div.product__media img"),),
    "royaldesign.se": (variants("div[role='combobox'] > a"),),
    "trademax.se": (
        *_GROUP_RECORDS,
        specs("main div:has(h3) tr", "td:nth-child(1)", "td:nth-child(2)"),
        Record("reviews", "div.reviewsList > div", (Rule("content", ":scope > div:nth-of-type(2) > p"),)),
    ),
    "trendrum.se": (
        crumbs("div#navBreadCrumb a", skip=1),
        specs(".FactsBox table tr", "td.attribName", "td.attribValue"),
        images(".infodisplay_left span.modal_image", take="href"),
    ),
    "unoliving.com": (crumbs("div.breadcrumbs li a", skip=1),),
    "venturedesign.se": (
        crumbs("div.breadcrumb-container a", skip=1),
        specs("div.container:has(> div.label:text('mer information')) > div.content tr", "td:nth-child(1)", "td:nth-child(2)"),
        images("div.article-detail-image div.v-thumb img"),
    ),
    "wayfair.de": (
        crumbs(".PdpLayoutResponsive-breadcrumbWrap nav li a"),
        images("li.ProductDetailImageCarousel-carouselItem img"),
        specs("div.ProductOverviewItem dl dt", ":scope", ":scope + dd"),
    ),
}
RECORDS["finnishdesignshop.com"] = RECORDS["finnishdesignshop.fi"]

CARD_RULES = {
    "andlight.dk": current("div.category-info h1"),
    "baldai1.lt": current("main span.ty-breadcrumbs__current"),
    "chilli.se": current("main nav span > span"),
    "connox.dk": current("div.w > section > div h1"),
    "ellos.se": current(".product-list-header h1"),
    "furniturebox.se": current("main nav span > span"),
    "gardenstore.se": current("div.breadcrumbs li strong"),
    "gigameubel.nl": current("div.breadcrumbs ul li:last-child"),
    "homeroom.se": (Rule("category", "ul.breadcrumbs ~ p.last-item"), Rule("category", ".content-wrapper-category-header h1", rank=1)),
    "jensen-company.dk": current("div.breadcrumbs ul li > strong"),
    "k-rauta.se": current(".subcategory-header h1"),
    "nordiskarum.se": current("li.sf-breadcrumbs__list-item a.sf-breadcrumbs__breadcrumb--current"),
    "nordlyliving.dk": current("nav.breadcrumb span:last-child"),
    "royaldesign.se": current("h1[font-size='7,,10']"),
    "trademax.se": current("main nav span > span"),
    "unoliving.com": current("div.breadcrumbs li strong"),
}
CARD_RECORDS = {
    "amazon.de": (cards("ul li.ProductGridItem__itemOuter__KUtvv", "a.Title__title__z5HRm", "a.Title__title__z5HRm"),),
    "andlight.dk": (cards("article.productCard", "span.productImage + a", "span.productImage a"), crumbs("a.BreadCrumbLink", skip=1)),
    "baldai1.lt": (
        cards("div.grid-list .ty-column3", ".ty-grid-list__item .product-title", ".ty-grid-list__item a.product-clickable"),
        crumbs("main a.ty-breadcrumbs__a", skip=1),
    ),
    "bernomobler.se": (cards("main div.grid article", "h3", "a:first-of-type"),),
    "bygghemma.se": (cards("main div.xqHsK", None, "div.FSL6m > a"), crumbs("a.PMDfl")),
    "chilli.se": _GROUP_CARDS,
    "connox.dk": (cards("div.product-list a.item-card", ".item-card__title", ":scope"), crumbs("section.breadcrumb ul#breadcrumb li a", skip=1)),
    "ebuy24.dk": (
        cards("div.row > div.m-productlist-list-item article", ".m-productlist-title", "header a:first-child"),
        crumbs("div.m-breadcrumb a", skip=1),
    ),
    "ellos.se": (cards("article.product-card", "h2.ellos-full-product-name", "a"), crumbs("ul.navigation-breadcrumb-items li a[href]")),
    "finnishdesignshop.fi": (
        cards(".product-list__item", ".product-list__manufacturer", ":scope > a:nth-of-type(1)", Rule("brand", ".product-list__manufacturer")),
    ),
    "furniturebox.se": _GROUP_CARDS,
    "gardenstore.se": (cards("li.product-item", ".product-item-name", ".product-item-name a"), crumbs("div.breadcrumbs li a", skip=1)),
    "gigameubel.nl": (cards("div.card-product", None, "a.product"), crumbs("div.breadcrumbs ul li a", skip=1)),
    "homeroom.se": (cards("article.product-card", None, "a"), crumbs("ul.breadcrumbs > li > a")),
    "jensen-company.dk": (
        cards("div#layer-product-list li.product-item", ".product-item-name", ".product-item-name a"),
        crumbs("div.breadcrumbs ul li a", skip=1),
    ),
    "k-rauta.se": (cards("article.product-list__card", ".product-card__name", "a.product-card"), crumbs("div.category-page--breadcrumbs a")),
    "macys.com": (
        cards("li.cell.sortablegrid-product", "h3.product-name", "a", Rule("brand", "div.product-brand")),
        crumbs("nav.breadcrumbs a.p-menuitem-link"),
    ),
    "nordiskarum.se": (
        cards(".sf-product-card", "a.sf-product-card__link h3", ":scope > a.sf-product-card__link"),
        crumbs("li.sf-breadcrumbs__list-item a:not(.sf-breadcrumbs__breadcrumb--current)", skip=1),
    ),
    "nordlyliving.dk": (
        cards("li.product", "h3.card__heading a", "h3.card__heading a", Rule("brand", "div.card--media > div.card__content div.card-vendor"),
              Rule("price_text", "div.price__sale span.price-item--sale"), Rule("price_text", "div.price__regular span.price-item--regular", rank=1)),
    ),
    "norliving.dk": (cards("div.collection product-card", "div.product-card__info a", "div.product-card__info a"),),
    "royaldesign.se": (cards("div[data-type='product_list_item']", None, "div > a"),),
    "trademax.se": _GROUP_CARDS,
    "trendrum.se": (cards("div.productListingOuterBox", "a.itemTitle", "a.itemTitle"), crumbs("div#navBreadCrumb a", skip=1)),
    "unoliving.com": (cards("ol li.plp__grid-item", "div.product-item-name", "div.product-item-name a"), crumbs("div.breadcrumbs li a")),
    "venturedesign.se": (cards("article.article", "h4", "a"), crumbs("div.breadcrumb-container a", skip=1)),
}
CARD_RECORDS["finnishdesignshop.com"] = CARD_RECORDS["finnishdesignshop.fi"]
